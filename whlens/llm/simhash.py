"""SimHash near-duplicates with pigeonring filtering.

Fingerprints of 64 bits are cut into five segments. If two differ in at most four
bits, then by the pigeonring principle some segment i starts a chain of segments
(i, i+1, ... around the ring) whose cumulative differences stay within their
shares of the budget: 0 bits in i, at most 1 in i and i+1, 2 in three, 3 in four.
Segment i is thus equal, and so is one half of segment i+1: these two are the
bucket key, ten keys a fingerprint. Within a bucket the rest of the chain is
checked before the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from whlens.llm.common import arrow_schema, components, partitions, slices, table, text_batches

SHINGLE = 4
MAX_BITS = 4
#: Rows of a bucket that one task holds; larger buckets are dealt out by pairs of blocks.
BLOCK_ROWS = 8192


# Fingerprints.

def _fingerprint(text: str | None, shingle: int) -> int:
    from xxhash import xxh64_intdigest
    words = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): the SimHash of each whole text's word shingles as a
    signed long, and Spark's xxhash64 of the text. A null text has no words."""
    text_batches(docs.sparkSession)
    ddl = "doc_id long, text_hash long, fp long"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = np.array([_fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.col("text").cast("string")).mapInArrow(run, ddl)


# Pigeonring.

class Ring:
    """Five segments of the 64 bits and the chain budgets for ``max_bits`` = 4."""

    def __init__(self, max_bits: int = MAX_BITS):
        self.n, self.max_bits = max_bits + 1, max_bits
        edges = [64 * i // self.n for i in range(self.n + 1)]
        mask = lambda a, b: ((1 << (b - a)) - 1) << a
        self.segments = [mask(a, b) for a, b in zip(edges, edges[1:])]
        self.halves = [(mask(a, (a + b) // 2), mask((a + b) // 2, b)) for a, b in zip(edges, edges[1:])]

    def keys(self) -> list[tuple[int, int]]:
        """(segment i, mask of the bits that are the bucket key)."""
        return [(i, self.segments[i] | half) for i in range(self.n) for half in self.halves[(i + 1) % self.n]]

    def chains(self, i: int) -> list[tuple[int, int]]:
        """(mask of the first 2, 3, ... segments from i on, bits they may differ in)."""
        out, mask = [], self.segments[i]
        for k in range(1, self.n):
            mask |= self.segments[(i + k) % self.n]
            out.append((mask, (k + 1) * self.max_bits // self.n))
        return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int]]) -> np.ndarray:
    """Which of the pairs hold the whole chain; its last part is the full distance."""
    diff, live = a ^ b, np.arange(len(a))
    for mask, most in chain:
        live = live[np.bitwise_count(diff[live] & np.uint64(mask)) <= most]
    return live


def _block_edges(left: np.ndarray, right: np.ndarray | None, chain: list[tuple[int, int]]) -> tuple[list, list]:
    """Edges that join what is linked within ``left`` (or between ``left`` and
    ``right``), fewer than there are rows: found breadth first, each row is reached
    once. A tree of sixteen branches, so that no row has many edges."""
    rows = left if right is None else np.concatenate([left, right])
    side = None if right is None else np.arange(len(rows)) < len(left)
    todo, a, b = np.arange(len(rows)), [], []
    while len(todo):
        queue, todo, group = [todo[0]], todo[1:], []
        while queue:
            at = queue.pop()
            group.append(at)
            among = todo if side is None else todo[side[todo] != side[at]]
            hit = among[_near(np.full(len(among), rows[at]), rows[among], chain)]
            if len(hit):
                queue.extend(hit.tolist())
                todo = np.setdiff1d(todo, hit, assume_unique=True)
        group = rows[group]
        for j in range(1, len(group)):
            a.append(group[j]), b.append(group[(j - 1) // 16])
    return a, b


def _bucket_edges(buckets: DataFrame, ring: Ring) -> DataFrame:
    """Edges within buckets (key, i, side, fp), sorted by key. Small buckets are
    compared by shifts over the whole batch, larger ones breadth first."""
    schema = arrow_schema("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def edges(key: np.ndarray, i: np.ndarray, side: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            large = (sizes > 32) | (side[starts] >= 0)
            a, b = [], []
            for s, n in zip(starts[large].tolist(), sizes[large].tolist()):
                part = slice(s, s + n)
                chain = ring.chains(int(i[s]))
                if side[s] < 0:
                    got = _block_edges(fp[part], None, chain)
                else:
                    got = _block_edges(fp[part][side[part] == 0], fp[part][side[part] == 1], chain)
                a += got[0]
                b += got[1]
            a, b = [np.array(a, np.uint64)], [np.array(b, np.uint64)]
            small = np.repeat(~large, sizes)
            key, i, fp = key[small], i[small], fp[small]
            for shift in range(1, 32):
                at = np.flatnonzero(key[shift:] == key[:-shift])
                if not len(at):
                    break
                for k in range(ring.n):
                    mine = at[i[at] == k]
                    mine = mine[_near(fp[mine], fp[mine + shift], ring.chains(k))]
                    a.append(fp[mine]), b.append(fp[mine + shift])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], schema=schema)

        for batch in batches:
            now = [batch.column(c).to_numpy() for c in range(4)]
            now[3] = now[3].view(np.uint64)
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            last = np.searchsorted(now[0], now[0][-1]) if len(now[0]) else 0  # the last key may go on
            held = [x[last:] for x in now]
            if last:
                yield edges(*(x[:last] for x in now))
        if held is not None and len(held[0]):
            yield edges(*held)

    return buckets.mapInArrow(run, "a long, b long")


def _key(fp: Column, number: int, mask: int) -> Column:
    """The key's bits, with its number in four of the bits that it doesn't use."""
    return F.xxhash64(fp.bitwiseAND(F.lit(_signed(mask))), F.lit(number))


def links(prints: DataFrame, max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): edges between the distinct fingerprints of ``prints`` (fp), so that
    two are in one component of the edges exactly if they are in one of all links
    of at most ``max_bits`` differing bits. Linear in the fingerprints: a bucket
    gives fewer edges than it has rows, or 31 a row if it has 32 at most."""
    spark, ring = prints.sparkSession, Ring(max_bits)
    keys = F.array(*[F.struct(_key(F.col("fp"), k, mask).alias("key"), F.lit(i).alias("i")) for k, (i, mask) in enumerate(ring.keys())])
    rows = prints.select("fp", F.explode(keys).alias("k")).select("k.key", "k.i", "fp")
    # Buckets of more rows than a task should hold are compared block by block.
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
    sizes = table(sizes.select("key", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")), "large")
    if sizes.isEmpty():
        dealt = rows.select("key", "i", F.lit(-1).alias("side"), "fp")
    else:
        mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
        split = rows.join(sizes, "key").withColumn("mine", mine)
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        split = (split.select("key", "i", "fp", "mine", other)
                 .select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "i",
                         F.when(F.col("mine") == F.col("other"), -1).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"), "fp"))
        dealt = rows.join(sizes, "key", "left_anti").select("key", "i", F.lit(-1).alias("side"), "fp").union(split)
    buckets = dealt.repartition(partitions(spark), "key").sortWithinPartitions("key", "side", "fp")
    return _bucket_edges(buckets, ring).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, group, component_id): component_id is the smallest doc_id
    that links of at most ``max_bits`` differing bits reach, itself included.

    Texts without a word have fingerprint zero. Rows of one doc_id are rows of
    their own; a null doc_id is larger than all others, and component_id is null
    only where no doc_id of the component is known; ``group`` names the component
    by one of its fingerprints. An empty table gives no rows.
    """
    prints = table(fingerprints(docs, shingle), "fingerprints")
    classes = table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    joined = components(links(classes, max_bits))
    # A component's smallest doc_id, from its classes; alone is every class without a link.
    whole = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("group"))
    smallest = whole.groupBy("group").agg(F.min("first").alias("component_id"))
    whole = whole.join(smallest, "group").select("fp", "group", "component_id")
    return prints.join(whole, "fp").select("doc_id", "text_hash", "fp", "group", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one with the
    smallest doc_id (a null one only if there is no other); of rows that repeat
    its doc_id and text, one."""
    found = near_duplicates(docs.select("doc_id", "text"), shingle, max_bits)
    lowest = F.lit(-(1 << 63)).cast("long")
    keep = (found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k"))
            .select(F.coalesce("k.doc_id", lowest).alias("id"), F.col("k.text_hash").alias("hash")))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), lowest).alias("id"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    copy = F.row_number().over(Window.partitionBy("id", "hash").orderBy("id"))
    return keyed.join(keep, ["id", "hash"]).withColumn("copy", copy).where("copy = 1").select("row.*")
