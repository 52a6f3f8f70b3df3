"""Interval join of two large sides as one sorted stream.

Facts and versions are range-partitioned by (keys, time) at cut points from a bounded
sample of the facts, and sorted; a task walks through them and carries the versions that
are open. A version that is still valid where the next partitions begin is sent there
too, so a copy of it is made for each cut it lies across and none for the days it lasts.
A hot key, even a hot instant of one, is split like any other range.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.operators.joins import cut_position, row_hash
from whlens.operators.nested import as_type, common_type

#: Facts sampled for each partition's cut point.
SAMPLE_ROWS = 32
#: Rows of an output batch.
BATCH_ROWS = 10_000
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _instant(df: DataFrame, name: str) -> Column:
    """A time column as microseconds, an integer one as it is."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(f"`{name}`").cast("timestamp"))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(f"`{name}`").cast("long")
    raise TypeError(f"{name} is {dtype.simpleString()}: times or integers are joined")


def _spread(batches: Iterator[pa.RecordBatch], cuts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Each version once for every partition that holds times of its validity."""
    for batch in batches:
        parts, rows = [], []
        for i, (k, start, end) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("k", "t", "e")))):
            low = bisect_right(cuts, (k, start, LEAST))
            high = bisect_right(cuts, (k, MOST if end is None else end, MOST))
            parts.extend(range(low, high + 1))
            rows.extend([i] * (high + 1 - low))
        for at in range(0, len(rows), BATCH_ROWS):
            taken = batch.take(pa.array(rows[at:at + BATCH_ROWS], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(parts[at:at + BATCH_ROWS], pa.int32()), *taken.columns], names=["part", *batch.schema.names])


def _match(batches: Iterator[pa.RecordBatch], closed: str, keep: bool, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Pairs of facts and open versions of a sorted partition."""
    key, still, held = None, [], None     # open: (end, position in held)
    for batch in batches:
        facts, versions = batch.column("f"), batch.column("v")
        before = 0 if held is None else len(held)
        held = versions if held is None else pa.concat_arrays([held, versions])
        of_fact, of_version = [], []

        def pairs(facts=facts):
            taken = facts.take(pa.array(of_fact, pa.int64())), held.take(pa.array(of_version, pa.int64()))
            of_fact.clear(), of_version.clear()
            return pa.RecordBatch.from_arrays(list(taken), names=list(names))

        for i, (k, t, is_fact, end) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("k", "t", "is_fact", "e")))):
            if k != key:
                key, still = k, []
            if not is_fact:
                still.append((end, before + i))
                continue
            if any(e is not None and e < t for e, _ in still):
                still = [v for v in still if v[0] is None or v[0] >= t]
            if closed == "left":
                found = [v for e, v in still if e is None or t < e]
            else:
                found = [v for e, v in still if e is not None]
            if not found and keep:
                found = [None]
            of_fact.extend([i] * len(found))
            of_version.extend(found)
            if len(of_fact) >= BATCH_ROWS:
                yield pairs()
        if of_fact:
            yield pairs()
        held = held.take(pa.array([v for _, v in still], pa.int64()))
        still = [(e, i) for i, (e, _) in enumerate(still)]


def sorted_interval_join(facts: DataFrame, versions: DataFrame, pairs: Sequence[tuple[str, str]], at: str, start: str, end: str,
                         how: str = "inner", closed: str = "left", facts_alias: str = "f", versions_alias: str = "v",
                         partitions: int | None = None) -> DataFrame:
    """``temporal_join`` of large sides: columns ``facts_alias`` and ``versions_alias`` hold
    the rows that were joined. Facts without a key or time match nothing, nor do versions
    without a key or start. The cut points take a job while the plan is built: a sample of
    ``SAMPLE_ROWS`` facts a partition, of their keys and times only."""
    spark = facts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = [common_type(facts.schema[a].dataType, versions.schema[b].dataType) for a, b in pairs]

    def key(df: DataFrame, columns: list[str]) -> Column:
        return F.to_json(F.struct(*[as_type(F.col(f"`{c}`"), df.schema[c].dataType, kind).alias(f"k{i}") for i, (c, kind) in enumerate(zip(columns, kinds))]))

    def known(df: DataFrame, columns: list[str]) -> Column:
        found = F.lit(True)
        for c in columns:
            found = found & F.col(f"`{c}`").isNotNull()
        return found

    def whole(df: DataFrame) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in df.columns])
    of_facts, of_versions = [a for a, _ in pairs], [b for _, b in pairs]
    there = known(facts, [*of_facts, at])
    f = facts.where(there).select(key(facts, of_facts).alias("k"), _instant(facts, at).alias("t"), row_hash(facts).alias("h"), whole(facts).alias("f"))
    sample = sorted(tuple(r) for r in f.select("k", "t", "h").orderBy(F.rand(7)).limit(SAMPLE_ROWS * n).collect())
    cuts = sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []
    points = spark.createDataFrame([(cuts,)], "cuts array<struct<k:string,t:long,h:long>>").scalar()
    f = f.withColumn("_cuts", points)
    f = f.withColumn("part", cut_position(F.col("_cuts"), max(1, len(cuts)), F.struct("k", "t", "h"), strict=False)).drop("_cuts", "h")

    kinds_of = {"f": facts.schema, "v": versions.schema}
    v = versions.where(known(versions, [*of_versions, start])).select(
        key(versions, of_versions).alias("k"), _instant(versions, start).alias("t"), _instant(versions, end).alias("e"), whole(versions).alias("v"))
    v = v.where("e is null or e >= t")
    spread = T.StructType([T.StructField("part", T.IntegerType()), *v.schema.fields])
    v = v.mapInArrow(lambda batches: _spread(batches, cuts), spread)
    both = (f.select("part", "k", "t", F.lit(True).alias("is_fact"), F.lit(None).cast("long").alias("e"), "f", F.lit(None).cast(kinds_of["v"]).alias("v"))
            .union(v.select("part", "k", "t", F.lit(False).alias("is_fact"), "e", F.lit(None).cast(kinds_of["f"]).alias("f"), "v")))
    stream = both.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("k", "t", "is_fact").drop("part")
    result = T.StructType([T.StructField(facts_alias, facts.schema), T.StructField(versions_alias, versions.schema)])
    keep, names = how == "facts_left", (facts_alias, versions_alias)
    out = stream.mapInArrow(lambda batches: _match(batches, closed, keep, names), result)
    if keep:
        out = out.union(facts.where(~there).select(whole(facts).alias(facts_alias), F.lit(None).cast(versions.schema).alias(versions_alias)))
    return out
