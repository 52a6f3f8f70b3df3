"""Join strategy and ordering helpers.

Where a physical form depends on a side's size, the size is the optimiser's own
estimate of its bytes (``plan_bytes``): known before anything runs, taken from file
sizes, never lowered by filters. No job is started while a plan is built. Sides that
may be facts (query rows, statement texts) get no hint at all; AQE chooses from the
measured shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest estimated size of a side that is broadcast (Parquet bytes; several times
# that in memory). Price, version and warehouse lists are far below it.
DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of ``df``'s size in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` is estimated at ``max_bytes`` or less. ``None`` is the default
    bound; 0 never broadcasts."""
    bound = DEFAULT_BROADCAST_BYTES if max_bytes is None else max_bytes
    return bound > 0 and plan_bytes(df) <= bound


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(_has_map(f.dataType) for f in dtype.fields)


def row_hash(df: DataFrame) -> Column:
    """A deterministic 64-bit hash of the row. Spark doesn't hash maps: a column that
    is or holds one is hashed as JSON text."""
    cols = [F.to_json(F.col(f"`{f.name}`")) if _has_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*cols) if cols else F.lit(0)


def spread_order(df: DataFrame, *order: Column) -> DataFrame:
    """Global sort by ``order`` with a row-hash tie-breaker.

    The result has the requested order; the extra key only ranks rows with
    equal sort values. It lets the range partitioner split a hot value (e.g.
    hourly usage rows sharing one timestamp) over several tasks instead of
    sending all of it to one."""
    return df.orderBy(*order, row_hash(df))


def cut_position(cuts: Column, n: int, value: Column, strict: bool = True) -> Column:
    """How many of the ascending array ``cuts`` (``n`` elements at most) lie below
    ``value``, or with ``strict=False`` not above it: a binary search."""
    steps = [1 << k for k in reversed(range(max(1, n).bit_length()))]
    size = F.size(cuts)

    def step(i: Column, s: Column) -> Column:
        cut = F.element_at(cuts, F.least(i + s, size))
        return F.when((i + s <= size) & (cut < value if strict else cut <= value), i + s).otherwise(i)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def quantile_order(df: DataFrame, column: str, narrow: DataFrame, descending: bool = False,
                   partitions: int | None = None) -> DataFrame:
    """Global sort of ``df`` by the time or number ``column``, in one pass over ``df``.

    A range partitioner would run ``df`` once more to sample it. Here the cut points are
    quantiles (a mergeable sketch) of the first column of ``narrow``, a cheap frame whose
    values are spread like ``column``'s; they are a scalar subquery, so no job runs while the
    plan is built. Rows that share a value that several cuts fall on are dealt to all of
    these partitions. Nulls come first, descending last."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if n < 2:
        return df.orderBy(F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_first(), row_hash(df))

    def number(c: Column, dtype: T.DataType) -> Column:
        is_time = isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
        return F.unix_micros(c.cast("timestamp")) if is_time else c.cast("double")
    first = narrow.schema.fields[0]
    found = narrow.agg(F.percentile_approx(number(F.col(first.name), first.dataType), [i / n for i in range(1, n)], max(10_000, 50 * n)).alias("cuts"))
    with_cuts = df.withColumns({"_cuts": found.scalar(), "_at": number(F.col(column), df.schema[column].dataType)})
    low, high = (cut_position(F.col("_cuts"), n - 1, F.col("_at"), strict) for strict in (True, False))
    part = F.coalesce(low + F.pmod(row_hash(df), high - low + 1).cast("int"), F.lit(0))
    if descending:
        part = F.lit(n - 1) - part
    dealt = with_cuts.withColumn("_part", part).drop("_cuts", "_at").repartitionById(n, "_part").drop("_part")
    order = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_first()
    return dealt.sortWithinPartitions(order, row_hash(df))
