"""Ranked lexical search with sparse ball trees.

A document is a sparse vector over the terms of the queries; its inner product with a
query's term counts is its score. One pass tokenizes the documents; the tasks of a
second one build a ball tree for every ``SHARD_ROWS`` vectors and ask it all queries.
A node knows its centroid c and the largest distance r of its vectors from it, so no
vector below it scores more than q·c + |q| r. Nodes are opened by falling bound until
no bound reaches the last of the best scores; leaves are scored in integers. Sums in
doubles are widened by more than their rounding can err, so no bound is too low.
Vectors are compared in the space scaled by the terms' weights: frequent terms, which
weigh little, hardly widen the balls.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from whlens.llm.common import arrow_schema, drop, slices, table, text_batches

TOP = 20
#: Distinct vectors of a ball tree, and of a leaf.
SHARD_ROWS, LEAF_ROWS = 8192, 64
#: Terms of the queries that are searched side by side; more queries are searched in blocks.
BLOCK_TERMS = 200_000

_TERM = b"abcdefghijklmnopqrstuvwxyz0123456789"
#: A-Z to a-z, all other ASCII but letters and digits to a space; bytes of other characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _TERM else 32 for c in range(256))

VECTORS = "doc_id long, n long, ids array<int>, tfs array<long>"
FOUND = "item long, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, as UTF-8."""
    # str.split() would also split at other white space, bytes.split() only at ASCII.
    return text.encode().translate(_FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class BallTree:
    """Ball tree of sparse vectors in CSR form: ``indptr``, term ``idx``, integer ``val``,
    and the terms' weights ``w``. ``rows`` is the order of the vectors in the leaves."""

    def __init__(self, indptr: np.ndarray, idx: np.ndarray, val: np.ndarray, w: np.ndarray, leaf: int = LEAF_ROWS):
        n = len(indptr) - 1
        self.width = len(w)
        scaled = val * w[idx].astype(float)
        length = np.diff(indptr)
        square = np.add.reduceat(scaled * scaled, indptr[:-1]) if n else np.zeros(0)
        # Relative error of a sum of k products in doubles is below k * 2**-52.
        self.unit = (int(length.max(initial=0)) + self.width + 16) * 2.0 ** -52
        self.rows = np.arange(n)
        self.span, self.children, self.radius, self.norm = [], [], [], []
        centre_term, centre_node, centre_value = [], [], []
        waiting = [(0, n, -1)] if n else []
        while waiting:
            lo, hi, parent = waiting.pop()
            rows, node = self.rows[lo:hi], len(self.span)
            take = np.concatenate([np.arange(indptr[r], indptr[r + 1]) for r in rows])
            starts = np.concatenate([[0], np.cumsum(length[rows])[:-1]])
            t, x = idx[take], scaled[take]
            centre = np.bincount(t, weights=x, minlength=self.width) / (hi - lo)
            c2 = float(centre @ centre)

            def distances(to, to2, t=t, x=x, starts=starts, rows=rows):
                """Squared distances from ``to``, and what they may be too low by."""
                dot = np.add.reduceat(x * to[t], starts)
                return square[rows] - 2 * dot + to2, 4 * self.unit * (square[rows] + to2)

            d2, slack = distances(centre, c2)
            self.span.append((lo, hi))
            self.children.append([])
            self.radius.append(math.sqrt(max(0.0, float((d2 + slack).max()))) * (1 + 2.0 ** -50))
            self.norm.append(math.sqrt(c2))
            at = np.flatnonzero(centre)
            centre_term.append(at), centre_node.append(np.full(len(at), node)), centre_value.append(centre[at])
            if parent >= 0:
                self.children[parent].append(node)
            if hi - lo <= leaf:
                continue

            def pivot(r):
                to = np.zeros(self.width)
                to[idx[indptr[r]:indptr[r + 1]]] = scaled[indptr[r]:indptr[r + 1]]
                return distances(to, square[r])[0]

            from_a = pivot(rows[int(d2.argmax())])
            from_b = pivot(rows[int(from_a.argmax())])
            half = (hi - lo) // 2
            self.rows[lo:hi] = rows[np.argsort(from_a - from_b, kind="stable")]
            waiting += [(lo, lo + half, node), (lo + half, hi, node)]
        # Centroids by term: a query reads those of its own terms only.
        term = np.concatenate(centre_term) if n else np.zeros(0, int)
        order = np.argsort(term, kind="stable")
        self.c_node = (np.concatenate(centre_node) if n else term)[order]
        self.c_value = (np.concatenate(centre_value) if n else term.astype(float))[order]
        self.c_start = np.searchsorted(term[order], np.arange(self.width + 1))
        self.radius, self.norm = np.array(self.radius), np.array(self.norm)
        # Vectors in the order of the leaves.
        take = np.concatenate([np.arange(indptr[r], indptr[r + 1]) for r in self.rows]) if n else np.zeros(0, int)
        self.indptr = np.concatenate([[0], np.cumsum(length[self.rows])])
        self.idx, self.val = idx[take], val[take]
        self.w, self.opened = w, 0

    def search(self, query: dict[int, int], ids: list[list], top: int = TOP) -> list[tuple[int, tuple]]:
        """The ``top`` best (score, id) of ``query`` (term: count) with a score above 0;
        ``ids`` has, for each vector, the ids it stands for, ascending."""
        if not len(self.radius):
            return []
        dots = np.zeros(len(self.radius))
        for t, times in query.items():
            part = slice(self.c_start[t], self.c_start[t + 1])
            dots[self.c_node[part]] += times * self.c_value[part]
        size = math.sqrt(sum(c * c for c in query.values()))
        bound = (dots + size * self.radius) + self.unit * size * (self.norm + self.radius) + 1
        factor = np.zeros(self.width, dtype=np.int64)
        for t, times in query.items():
            factor[t] = times * int(self.w[t])
        best: list[tuple[int, tuple]] = []
        least = 1  # what the last of the best scores
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= least:
            high, node = heapq.heappop(heap)
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (max(high, -bound[child]), child))
                continue
            self.opened += 1
            lo, hi = self.span[node]
            a, b = self.indptr[lo], self.indptr[hi]
            scores = np.add.reduceat(self.val[a:b] * factor[self.idx[a:b]], self.indptr[lo:hi] - a)
            more = [(-int(scores[i]), key) for i in np.flatnonzero(scores >= least) for key in ids[self.rows[lo + i]][:top]]
            if more:
                best = sorted(best + more)[:top]
                if len(best) == top:
                    least = -best[-1][0]
        return [(-s, key) for s, key in best]


def _vectorize(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(VECTORS)
    known = vocabulary.keys()
    for batch in slices(batches):
        out = [[], [], [], []]
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = terms(text)
            counts = Counter(words)
            held = sorted((vocabulary[t], counts[t]) for t in counts.keys() & known)
            for column, value in zip(out, (key, len(words), [i for i, _ in held], [c for _, c in held])):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)


def _shard_results(vectors: dict, w: np.ndarray, queries: dict[int, dict[int, int]], top: int) -> dict[str, list]:
    """Every query's best of one shard; ``vectors`` maps (ids, values) to document ids."""
    keys = list(vectors)
    idx = [np.frombuffer(k[0], dtype=np.int32) for k in keys]
    val = [np.frombuffer(k[1], dtype=np.int64) for k in keys]
    indptr = np.concatenate([[0], np.cumsum([len(i) for i in idx])]).astype(np.int64)
    tree = BallTree(indptr, np.concatenate(idx).astype(np.int64), np.concatenate(val), w)
    ids = [sorted(vectors[k]) for k in keys]
    out = {"item": [], "doc_id": [], "score": []}
    for item, query in queries.items():
        for score, (_, key) in tree.search(query, ids, top):
            out["item"].append(item), out["doc_id"].append(key), out["score"].append(score)
    return out


def _search_shards(batches: Iterator[pa.RecordBatch], w: np.ndarray, n_docs: int, n_terms: int, queries: dict[int, dict[int, int]], top: int) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(FOUND)
    vectors: dict[tuple[bytes, bytes], list] = defaultdict(list)

    def results() -> pa.RecordBatch:
        found = _shard_results(vectors, w, queries, top)
        vectors.clear()
        return pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in schema], schema=schema)

    for batch in slices(batches, 1024):
        all_ids, all_tfs = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
        ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
        starts = np.concatenate([[0], ends[:-1]])
        for key, n, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), starts, ends):
            ids, tf = all_ids[a:b], all_tfs[a:b]
            weighs = w[ids] > 0
            ids, tf = ids[weighs], tf[weighs]
            if not len(ids):
                continue
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            val = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
            same = vectors[ids.tobytes(), val.tobytes()]
            # Of equal vectors, only the lowest ids can be among the best.
            same.append((key is None, key))
            if len(same) > 4 * top:
                same[:] = sorted(same)[:top]
            if len(vectors) >= SHARD_ROWS:
                yield results()
    if vectors:
        yield results()


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [(item, t, c) for item, text in zip(*(c.to_pylist() for c in batch.columns)) for t, c in Counter(terms(text)).items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.int64()))],
                                         names=["item_id", "term", "times"])


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` documents (doc_id long, text) of each item (item_id long, text) by score:
    (item_id, rank, doc_id, score), ranks from 1; equal scores by ascending doc_id (null last).

    Texts are read whole; null or empty ones have no terms: such items get no rows,
    such documents none either. Rows that share an item_id (null too) are one item with
    the terms of all of them. Rows that share a doc_id are documents of their own.
    Only documents with a score above 0 are ranked. Empty tables give no rows.
    Each block of queries, ``block_terms`` terms or one item, is asked of all documents.
    """
    spark = docs.sparkSession
    text_batches(spark)
    asked = table(items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
                  .mapInArrow(_query_terms, "item_id long, term binary, times long")
                  .groupBy("item_id", "term").agg(F.sum("times").alias("times")), "queries")
    blocks = max(1, -(-asked.count() // block_terms))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = [f for b in range(blocks) if (f := _search_block(docs, asked.where(block == b), top)) is not None]
    out = found[0] if found else spark.createDataFrame([], FOUND.replace("item ", "item_id "))
    for more in found[1:]:
        out = out.unionByName(more)
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    out = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_block(docs: DataFrame, asked: DataFrame, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    rows = asked.collect()  # a block's terms: bounded
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    if not vocabulary:
        return None
    names = sorted({r["item_id"] for r in rows}, key=lambda x: (x is None, x or 0))
    number = {name: i for i, name in enumerate(names)}
    vectors = table(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                    .mapInArrow(lambda batches: _vectorize(batches, vocabulary), VECTORS), "vectors")
    n_docs, n_terms = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    df = {r["id"]: r["count"] for r in vectors.select(F.explode("ids").alias("id")).groupBy("id").count().collect()}
    if not df:
        drop(vectors)
        return None
    w = np.array([weight(n_docs, df[i]) if i in df else 0 for i in range(len(vocabulary))], dtype=np.int64)
    queries: dict[int, dict[int, int]] = defaultdict(dict)
    for r in rows:
        t = vocabulary[bytes(r["term"])]
        if w[t] > 0:
            queries[number[r["item_id"]]][t] = r["times"]
    queries = dict(queries)
    found = table(vectors.where(F.size("ids") > 0).mapInArrow(lambda batches: _search_shards(batches, w, n_docs, n_terms, queries, top), FOUND), "found")
    drop(vectors)
    ids = spark.createDataFrame([(i, name) for name, i in number.items()], "item long, item_id long")
    return found.join(ids, "item").select("item_id", "doc_id", "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS doc,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), total AS (
  SELECT count(*) FILTER (len(words) > 0) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM docs
), tf AS (
  SELECT doc, doc_id, n, term, count(*) AS tf
  FROM (SELECT doc, doc_id, len(words) AS n, unnest(words) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term
), scored AS (
  SELECT item_id, doc, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), total GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""
