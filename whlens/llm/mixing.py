"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The cells' tokens are raked until
their sums by source, by language and by topic have the target shares; a document is
then kept with its cell's calibrated probability.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from whlens.llm.common import SALTS, drop, slices, table, text_batches
from whlens.llm.langid import unit

MARGINS = ("source", "lang", "topic")
#: Without targets, a margin's target shares are its own to this power: small
#: categories gain, large ones lose.
TEMPER = 0.7
#: Share of all tokens that the kept documents have, as expected.
BUDGET = 0.6
TOLERANCE, SWEEPS, SWEEPS_A_JOB = 1e-4, 60, 6
#: Topics: clusters of hashed words of all documents, in this many passes at most.
TOPICS, ROUNDS, BUCKETS = 8, 12, 1024
#: Vectors are summed as whole multiples of 1 / SCALE.
SCALE = float(1 << 30)
#: Cells are broadcast up to this number; beyond it the join is salted.
BROADCAST_CELLS = 50_000
#: Cells are raked in one task up to this number; beyond it they are shuffled by each margin.
TASK_CELLS = 50_000
SEED = 17


# Topics.

@cache
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def word_counts(texts: list[str | None]) -> tuple[np.ndarray, list[int]]:
    """Hashed counts of lower-cased words, a row per text, and the number of words."""
    out, sizes = np.zeros((len(texts), BUCKETS)), []
    if _bucket.cache_info().currsize > 100_000:
        _bucket.cache_clear()
    for i, text in enumerate(texts):
        words = (text or "").lower().split()
        sizes.append(len(words))
        if words:
            out[i] = np.bincount(np.fromiter(map(_bucket, words), np.int64, len(words)), minlength=BUCKETS)
    return out, sizes


def _packed(values: np.ndarray, lengths: np.ndarray, kind: type) -> pa.Array:
    """Lists of numbers, one after the other in ``values``, as binaries: cheaper than arrays between the JVM and Python."""
    data = values.astype(kind)
    ends = np.concatenate([[0], np.cumsum(lengths)]) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _unpacked(lists: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, their number in each row) of a ``_packed`` array."""
    if not len(lists):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    lists = lists.cast(pa.binary())
    ends = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1]
    data = np.frombuffer(lists.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return np.frombuffer(data.tobytes(), kind), np.diff(ends) // np.dtype(kind).itemsize


def _sparse(texts: pa.Array) -> pa.Array:
    """(at, n, tokens) of each text: its buckets, their counts, and the number of words and an end."""
    at, n, lengths, tokens = [np.zeros(0)], [np.zeros(0)], [np.zeros(0, np.int64)], []
    for i in range(0, len(texts), 64):
        counts, sizes = word_counts(texts[i:i + 64].to_pylist())
        rows, buckets = np.nonzero(counts)
        at.append(buckets), n.append(counts[rows, buckets]), lengths.append(np.bincount(rows, minlength=len(sizes)))
        tokens += [s + 1 for s in sizes]
    lengths = np.concatenate(lengths)
    lists = [_packed(np.concatenate(c), lengths, kind) for c, kind in ((at, np.uint16), (n, np.uint32))]
    return pa.StructArray.from_arrays([*lists, pa.array(tokens, pa.int64())], ["at", "n", "tokens"])


def _weighted(at: pa.Array, n: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts times ``idf``, a row per text."""
    buckets, lengths = _unpacked(at, np.uint16)
    row = np.repeat(np.arange(len(at)), lengths)
    w = (1 + np.log(_unpacked(n, np.uint32)[0])) * idf[buckets]
    out = np.zeros((len(at), BUCKETS))
    out[row, buckets] = w / np.sqrt(np.bincount(row, w * w, len(at)))[row]
    return out


def _cosines(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x @ centroids.T).round(9)   # sums of another order tie too


def hashed(text: Column) -> Column:
    """Text -> struct(at, n, tokens)."""
    return F.arrow_udf(lambda texts: _sparse(texts), "at binary, n binary, tokens long")(text.cast("string"))


@dataclass
class Topics:
    idf: np.ndarray
    centroids: np.ndarray

    def of(self, at: pa.Array, n: pa.Array) -> pa.Array:
        """The nearest centroid of each text; -1 of one without a word."""
        out = [np.zeros(0, np.int32)]
        for i in range(0, len(at), 256):
            near = _cosines(_weighted(at[i:i + 256], n[i:i + 256], self.idf), self.centroids).argmax(axis=1)
            out.append(np.where(_unpacked(at[i:i + 256], np.uint16)[1] > 0, near, -1).astype(np.int32))
        return pa.array(np.concatenate(out))


def topic_model(vectors: DataFrame, topics: int = TOPICS, rounds: int = ROUNDS) -> Topics:
    """Inverse document frequencies, and centroids by spherical k-means, of every row of
    ``vectors`` (at, n). Each step is one pass over all rows; what comes back is a sum per
    centroid and bucket, or the one row farthest from all centroids. Sums are of whole
    numbers, so they are the same in any order of rows."""
    vectors = vectors.select("at", "n").where(F.octet_length("at") > 0)

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)      # documents with the bucket; the last: all
        for batch in batches:
            seen += np.append(np.bincount(_unpacked(batch.column(0), np.uint16)[0], minlength=BUCKETS), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1), pa.int32()), pa.array(seen)], names=["at", "n"])

    seen = np.zeros(BUCKETS + 1)
    for r in vectors.mapInArrow(holding, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        seen[r["at"]] = r["n"]
    n, df = int(seen[-1]), seen[:-1]
    idf = np.log((1 + n) / (1 + df)) + 0.1
    if not n:
        return Topics(idf, np.zeros((1, BUCKETS)))

    def means(centroids: np.ndarray) -> np.ndarray:
        k = len(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((k, BUCKETS), np.int64)
            for batch in slices(batches):
                x = _weighted(batch.column(0), batch.column(1), idf)
                near = _cosines(x, centroids).argmax(axis=1)
                whole = np.rint(x * SCALE)
                sums += ((near == np.arange(k)[:, None]).astype(float) @ whole).astype(np.int64)
            of, at = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.array(at, pa.int32()), pa.array(sums[of, at])], names=["of", "at", "value"])

        out = np.zeros((k, BUCKETS))
        for r in vectors.mapInArrow(run, "of int, at int, value long").groupBy("of", "at").agg(F.sum("value").alias("value")).collect():
            out[r["of"], r["at"]] = r["value"]
        return np.where(out.any(axis=1)[:, None], unit(out), centroids)

    def farthest(centroids: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                near = _cosines(_weighted(batch.column(0), batch.column(1), idf), centroids).max(axis=1)
                i = int(near.argmin())
                yield pa.RecordBatch.from_arrays([pa.array([near[i]]), *[c.slice(i, 1) for c in batch.columns]], names=["near", "at", "n"])

        found = vectors.mapInArrow(run, "near double, at binary, n binary").agg(F.min(F.struct("near", "at", "n"))).first()[0]
        return _weighted(*[pa.array([bytes(found[c])], pa.binary()) for c in ("at", "n")], idf)

    centroids = means(np.zeros((1, BUCKETS)))
    while len(centroids) < min(topics, n):
        centroids = np.concatenate([centroids, farthest(centroids)])
    for _ in range(rounds):
        before, centroids = centroids, means(centroids)
        if np.array_equal(before, centroids):
            break
    return Topics(idf, centroids)


def topic_column(model: Topics):
    """Column function text -> struct(topic, tokens): the nearest of the model's
    centroids, and the number of words and an end. A text without a word has topic -1."""
    def topic(texts: pa.Array) -> pa.Array:
        found = _sparse(texts)
        return pa.StructArray.from_arrays([model.of(found.field(0), found.field(1)), found.field(2)], ["topic", "tokens"])

    return F.arrow_udf(topic, "topic int, tokens long")


# Raking.

def together(cells: DataFrame) -> DataFrame:
    """Cells in one partition if they are few: sums by any margin need no shuffle then."""
    return cells.coalesce(1) if cells.limit(TASK_CELLS + 1).count() <= TASK_CELLS else cells


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> DataFrame:
    """Adds ``weight`` to ``cells`` (the margins, tokens): shares of all tokens whose
    sums by each margin are those of ``targets`` (margin -> (value, share)), in
    proportion to the cells' own tokens otherwise.

    Sweeps end when every sum is within ``tolerance`` of its target, relatively, or
    after ``sweeps`` (targets that the cells can't meet: the last margin's hold).
    A value without a target has share 0; targets of absent values go to the others.
    """
    for m in MARGINS:
        t = targets[m].select(F.col("value").alias("of"), F.col("share").alias(f"to_{m}"))
        cells = cells.join(t, F.col(m).eqNullSafe(F.col("of")), "left").drop("of")
    cells = table(cells.fillna(0.0, [f"to_{m}" for m in MARGINS]).withColumn("weight", F.col("tokens").cast("double")), "cells")
    cells = together(cells)
    whole = [cells.groupBy(m).agg(F.first(f"to_{m}").alias("t")).agg(F.coalesce(F.sum("t"), F.lit(0.0))).first()[0] for m in MARGINS]
    for _ in range(0, sweeps, SWEEPS_A_JOB):
        for _ in range(SWEEPS_A_JOB):
            for m, total in zip(MARGINS, whole):
                now = F.sum("weight").over(Window.partitionBy(m))
                cells = cells.withColumn("weight", F.when(now > 0, F.col("weight") * F.col(f"to_{m}") / (total or 1.0) / now).otherwise(0.0))
        cells = together(table(cells, "cells"))
        off = [cells.groupBy(m).agg((F.abs(F.sum("weight") - F.first(f"to_{m}") / (total or 1.0)) / (F.first(f"to_{m}") / (total or 1.0) + 1e-12)).alias("off"))
               for m, total in zip(MARGINS, whole)]
        worst = reduce(DataFrame.union, off).agg(F.max("off")).first()[0]
        if worst is None or worst < tolerance:
            break
    return cells.select(*MARGINS, "tokens", "weight")


def tempered(cells: DataFrame, margin: str, temper: float = TEMPER) -> DataFrame:
    """Targets (value, share) of a margin: its shares of tokens to the power ``temper``."""
    return cells.groupBy(F.col(margin).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), temper).alias("share"))


def calibrate(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Adds ``probability`` = min(1, s * weight / tokens), with s such that the expected
    tokens kept are ``budget`` of all. One running sum over the cells, sorted by the s
    at which they are full."""
    order = Window.orderBy(F.col("full"), *MARGINS)
    rows = together(cells).withColumn("full", F.when(F.col("weight") > 0, F.col("tokens") / F.col("weight")))
    rows = table(rows.withColumn("wanted", F.lit(budget) * F.sum("tokens").over(Window.partitionBy(F.lit(0)))), "cells")
    rows = together(rows)
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    live = rows.where("full is not null").withColumn("s", (F.col("wanted") - F.coalesce(F.sum("tokens").over(upto), F.lit(0))) / F.sum("weight").over(rest))
    # The first cell that isn't full at its own s gives s; if all are full, every document is kept.
    s = live.where("s <= full").agg(F.min_by("s", F.struct("full", *MARGINS))).first()[0]
    s = float("inf") if s is None else s
    full = F.when(F.col("weight") > 0, F.least(F.lit(1.0), F.lit(s) * F.col("weight") / F.col("tokens"))).otherwise(0.0)
    return cells.withColumn("probability", full)


def chance(seed: int = SEED) -> Column:
    """A number in [0, 1) by a hash of doc_id and text: the same for the same document."""
    return (F.xxhash64("doc_id", "text", F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))


def cell_rates(rows: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER, budget: float = BUDGET) -> DataFrame:
    """(margins, tokens, weight, probability) of the cells of ``rows`` (margins, tokens)."""
    cells = table(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    targets = {m: tempered(cells, m, temper) for m in MARGINS} | (targets or {})
    return table(calibrate(table(rake(cells, targets), "raked"), budget), "rates")


def with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` with their cell's probability and weight. Cells are broadcast if they are
    few; otherwise a hot cell's rows are dealt out by a salt."""
    rates = rates.select(*[F.col(m).alias("of_" + m) for m in MARGINS], "probability", "weight")
    same = reduce(lambda a, b: a & b, [F.col(m).eqNullSafe(F.col("of_" + m)) for m in MARGINS])
    if rates.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS:
        joined = rows.join(F.broadcast(rates), same)
    else:
        salted = rates.withColumn("cell_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("row_salt", F.floor(F.col("chance") * 2 ** 20 % SALTS).cast("int")).join(salted, same & (F.col("row_salt") == F.col("cell_salt"))).drop("row_salt", "cell_salt")
    return joined.drop(*["of_" + m for m in MARGINS])


def placed(docs: DataFrame, topic) -> DataFrame:
    """Margins, tokens and ``chance`` of each document, with its own columns in ``row``."""
    rows = docs.select(F.struct("*").alias("row"), chance().alias("chance"), F.col("source").cast("string"), F.col("lang").cast("string"),
                       topic(F.col("text").cast("string")).alias("t"))
    return rows.select("row", "chance", "source", "lang", "t.topic", "t.tokens")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, ``chance``, source, lang, tokens and hashed word counts (at, n) of each document, as a table."""
    text_batches(docs.sparkSession)
    rows = docs.select("doc_id", chance().alias("chance"), F.col("source").cast("string"), F.col("lang").cast("string"), hashed(F.col("text")).alias("v"))
    return table(rows.select("doc_id", "chance", "source", "lang", "v.tokens", "v.at", "v.n"), "counted")


def with_topic(vectors: DataFrame, model: Topics) -> DataFrame:
    """A table of ``counted``'s rows with their topic instead of their words."""
    rows = vectors.withColumn("topic", F.arrow_udf(lambda at, n: model.of(at, n), "int")("at", "n")).drop("at", "n")
    return table(rows, "placed")


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER, budget: float = BUDGET) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability and kept of every document.

    ``targets``: margin -> (value, share), by default each margin's own shares to the
    power ``temper``. kept: the hash of doc_id and text is below the cell's probability,
    so repeated rows are kept or dropped together. Null sources and languages are
    values like others; a text without a word has one token, its end. No rows, no result.
    """
    vectors = counted(docs)
    rows = with_topic(vectors, topic_model(vectors))
    drop(vectors)
    out = with_rates(rows, cell_rates(rows, targets, temper, budget))
    return out.select("doc_id", *MARGINS, "tokens", "probability", (F.col("chance") < F.col("probability")).alias("kept"))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER, budget: float = BUDGET) -> DataFrame:
    """The documents that ``mix`` keeps, with all their columns. Texts aren't shuffled."""
    vectors = counted(docs)
    model = topic_model(vectors)
    rates = cell_rates(with_topic(vectors, model), targets, temper, budget)
    drop(vectors)
    return with_rates(placed(docs, topic_column(model)), rates).where("chance < probability").select("row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
