"""Near-duplicate vectors by small-world graphs: one graph per shard, every shard of a
label asked for every vector of it, cosines verified, links joined into components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from whlens.llm.common import components, partitions, table
from whlens.llm.hnsw import Graph, build

LEAST_COSINE = 0.98
#: Vectors of a graph, and of a block of queries: what a task holds.
SHARD_ROWS, QUERY_ROWS = 20_000, 20_000
MIN_SHARDS = 2
#: Beams start with this width and are doubled until an audit finds all links of the share
#: RECALL of the vectors that have any. It compares vectors with the whole shard until AUDIT
#: clusters have been met or none is left; each cluster counts once, by GROUP_ROWS at most.
#: Beams that a SCAN-th of the shard would fill give way to comparing with all of it.
BEAM, AUDIT, RECALL, GROUP_ROWS, SCAN, SCAN_ROWS = 24, 96, 0.99, 8, 16, 64
BLOCK = 512


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Double precision, of raw vectors."""
    return (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1))


class Shard:
    """A graph, its vectors' ids and counts, and which of them are linked."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, raw: np.ndarray, graph: Graph, least: float):
        self.ids, self.copies, self.raw, self.graph, self.least = ids, copies, raw, graph, least
        self.beam, self.exact = BEAM, False
        self._cluster()
        self.audit(ids, raw)

    def _cluster(self) -> None:
        """Clusters of rows that verified links along the graph's edges join; the smallest id names each."""
        n, links = len(self.ids), self.graph.links[0]
        a, b = np.repeat(np.arange(n), links.shape[1]), links.ravel()
        a, b = a[b >= 0], b[b >= 0]
        near = np.concatenate([self._pairs(a[i:i + (1 << 16)], self.raw[b[i:i + (1 << 16)]]) for i in range(0, max(len(a), 1), 1 << 16)])
        a, b = a[near >= self.least], b[near >= self.least]
        label = np.arange(n)
        while True:
            low = label.copy()
            np.minimum.at(low, a, label[b])
            np.minimum.at(low, b, label[a])
            low = low[low]
            if np.array_equal(low, label):
                break
            label = low
        self.cluster = label
        order = np.argsort(label, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(label[order]) > 0])) if n else np.zeros(0, int)
        self.members = {int(label[order[s]]): order[s:e] for s, e in zip(starts, [*starts[1:], n])}

    def _pairs(self, at: np.ndarray, other: np.ndarray) -> np.ndarray:
        mine = self.raw[at]
        return np.einsum("ij,ij->i", mine, other) / (np.linalg.norm(mine, axis=1) * np.linalg.norm(other, axis=1))

    def audit(self, own: np.ndarray, raw: np.ndarray) -> None:
        """Widen the beams until the links of these queries are found."""
        order, at, want, groups = np.random.default_rng(len(own)).permutation(len(own)), [], [], {}
        for i in range(0, len(order), AUDIT):
            part = order[i:i + AUDIT]
            near = (cosines(raw[part], self.raw) >= self.least) & (own[part][:, None] != self.ids)
            for q in np.flatnonzero(near.any(axis=1)):
                rows = groups.setdefault(int(self.cluster[near[q]].min()), [])
                if len(rows) < GROUP_ROWS:
                    rows.append(len(at))
                    at.append(part[q])
                    want.append(int(near[q].sum()))
            if len(groups) >= AUDIT:
                break
        while at and not self.exact:
            whole = np.array([n for n, _ in self.links(own[at], raw[at], counted=False)]) >= want
            if np.mean([whole[rows].mean() for rows in groups.values()]) >= RECALL:
                break
            self.beam *= 2
            self.exact = self.beam * SCAN >= len(self.ids)

    def _scan(self, own: np.ndarray, raw: np.ndarray, weight: np.ndarray) -> list[tuple[int, list[int]]]:
        """``links`` by comparing with the whole shard."""
        out = []
        for at in range(0, len(raw), SCAN_ROWS):
            near = (cosines(raw[at:at + SCAN_ROWS], self.raw) >= self.least) & (own[at:at + SCAN_ROWS][:, None] != self.ids)
            out += [(int(weight[n].sum()), sorted(self.ids[np.unique(self.cluster[n])].tolist())) for n in near]
        return out

    def links(self, own: np.ndarray, raw: np.ndarray, counted: bool = True) -> list[tuple[int, list[int]]]:
        """For each query (its id in ``own``) how many other vectors it is linked with
        (rows, or copies too), and the smallest id of each cluster that has one. A beam
        that meets a cluster is widened to all of it."""
        unit = (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)
        weight = self.copies if counted else np.ones(len(self.ids), np.int64)
        if self.exact:
            return self._scan(own, raw, weight)
        total, joined = np.zeros(len(raw), np.int64), [[] for _ in raw]
        for at in range(0, len(raw), BLOCK):
            ids, sims = self.graph.search(unit[at:at + BLOCK], self.beam)
            row, col = np.nonzero((sims >= self.least - 1e-3) & (ids >= 0))
            pairs = np.unique(np.stack([self.cluster[ids[row, col]], row + at], 1), axis=0)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(pairs[:, 0]) > 0])) if len(pairs) else []
            for s, e in zip(starts, [*starts[1:], len(pairs)]):
                name, asked = int(pairs[s, 0]), pairs[s:e, 1]
                members = self.members[name]
                for m in range(0, len(members), 4096):
                    part = members[m:m + 4096]
                    near = (cosines(raw[asked], self.raw[part]) >= self.least) & (own[asked][:, None] != self.ids[part])
                    total[asked] += near @ weight[part]
                    for q in asked[near.any(axis=1)]:
                        joined[q].append(int(self.ids[name]))
        return list(zip(total.tolist(), [sorted(set(j)) for j in joined]))


GRAPHS = "label long, dims int, shard int, ids binary, copies binary, raw binary, graph binary"
FOUND = "id long, n long, near array<long>"


def _valid(vectors: DataFrame) -> DataFrame:
    """Rows that can link, with a hash of label and direction-free components."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(e, lambda v: v != 0)
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.transform("embedding", lambda v: v.cast("double") + F.lit(0.0)).alias("raw"),
                          (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & some, F.lit(False))).alias("valid"))
    return rows.withColumns({"h1": F.xxhash64("label", "raw"), "h2": F.xxhash64("raw", F.lit(1), "label")})


def _build(least: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = np.array(pdf["raw"].tolist(), np.float64)
        pdf, raw = pdf.iloc[(by := np.argsort(pdf["id"].to_numpy(), kind="stable"))], raw[by]
        order, graph = build((raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32))
        head = pdf.iloc[0]
        return pd.DataFrame([(head["label"], head["dims"], head["shard"], pdf["id"].to_numpy(np.int64)[order].tobytes(),
                              pdf["copies"].to_numpy(np.int64)[order].tobytes(), raw[order].tobytes(), graph.to_bytes())],
                            columns=["label", "dims", "shard", "ids", "copies", "raw", "graph"])
    return run


def _ask(least: float):
    def run(graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(graphs) or not len(queries):
            return pd.DataFrame([], columns=["id", "n", "near"])
        g = graphs.iloc[0]
        ids = np.frombuffer(g["ids"], np.int64)
        shard = Shard(ids, np.frombuffer(g["copies"], np.int64), np.frombuffer(g["raw"], np.float64).reshape(len(ids), -1), Graph.from_bytes(g["graph"]), least)
        own, raw = queries["id"].to_numpy(np.int64), np.array(queries["raw"].tolist(), np.float64)
        shard.audit(own, raw)  # those of other shards too
        found = shard.links(own, raw)
        rows = [(i, n, near) for i, (n, near) in zip(queries["id"], found) if n]
        return pd.DataFrame(rows, columns=["id", "n", "near"])
    return run


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Links of cosine ``least`` or more between ``vectors`` (vec_id, embedding, label)
    of one label and size: vec_id, n_links, component_id, kept, a row per vector.

    Equal vectors are one class with a count. Vectors that are null, zero or hold a null
    or non-finite component, and null labels, link with nothing; so does a null vec_id,
    whose component_id is null and kept false. Graphs and blocks of queries have bounded
    sizes: a label of any size is many of both. No rows, no result.
    """
    spark = vectors.sparkSession
    rows = _valid(vectors.select("vec_id", "embedding", "label"))
    classes = (rows.where("valid").groupBy("h1", "h2", "label", F.size("raw").alias("dims"))
               .agg(F.min("vec_id").cast("long").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw")))
    classes = table(classes, "vectors")
    sizes = classes.groupBy(F.col("label").alias("of_label"), F.col("dims").alias("of_dims")).agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.select("*", F.greatest(F.lit(MIN_SHARDS), F.ceil(F.col("rows") / shard_rows)).cast("int").alias("shards"),
                         F.ceil(F.col("rows") / query_rows).cast("int").alias("blocks"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("of_salt"))
    salt = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(16)).cast("int")
    dealt = (classes.withColumn("salt", salt).join(sizes, (F.col("label") == F.col("of_label")) & (F.col("dims") == F.col("of_dims")) & (F.col("salt") == F.col("of_salt")))
             .withColumns({"shard": F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"), "block": F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")}))
    n = partitions(spark)
    graphs = table(dealt.repartition(n, "label", "dims", "shard").groupBy("label", "dims", "shard").applyInPandas(_build(least), GRAPHS), "graphs")
    counts = sizes.where("of_salt = 0").select("of_label", "of_dims", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    asked = graphs.join(counts, (F.col("label") == F.col("of_label")) & (F.col("dims") == F.col("of_dims"))).drop("of_label", "of_dims")
    queries = dealt.select("label", "dims", "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "id", "raw")
    keys = ["label", "dims", "shard", "block"]
    found = table(asked.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(_ask(least), FOUND), "found")
    joined = components(found.select(F.col("id").alias("a"), F.explode("near").alias("b")))
    linked = (classes.select("h1", "h2", "id", "copies")
              .join(found.groupBy("id").agg(F.sum("n").alias("n")), "id", "left")
              .join(joined.withColumnRenamed("node", "id"), "id", "left")
              .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")))
    single = F.col("component").isNull()
    return (rows.select("vec_id", "valid", F.when(F.col("valid"), F.col("h1")).alias("h1"), F.when(F.col("valid"), F.col("h2")).alias("h2"))
            .join(linked, ["h1", "h2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(single, F.col("vec_id")).otherwise(F.col("component")).cast("long").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
