"""Column profiles.

Both profiles read the table once: a single global aggregate with one
min/max/count/... per column (partial aggregation on every task, a one-row
final merge), then ``stack`` turns the one wide row into one row per column.
The source warehouse scans the table once per column instead.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.operators.batches import BATCH, in_batches
from whlens.operators.nested import tag

log = logging.getLogger(__name__)

# Spark types that stand for SQL Server's int, bigint, smallint, decimal,
# numeric, float and real. tinyint (ByteType), money and dates are excluded.
MIN_MAX_TYPES = (T.IntegerType, T.LongType, T.ShortType, T.DecimalType, T.DoubleType, T.FloatType)
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType,
                 T.DoubleType, T.FloatType)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _common_type(fields: Sequence[T.StructField]) -> str:
    """Type of the stacked value column, as ``UNION ALL`` would coerce it:
    double if any floating column is present, else a decimal wide enough."""
    if any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in fields):
        return "double"
    scale = max([f.dataType.scale for f in fields if isinstance(f.dataType, T.DecimalType)] or [0])
    return f"decimal(38,{scale})"


def column_min_max(df: DataFrame, table_name: str, value_type: str | None = None,
                   types=MIN_MAX_TYPES) -> DataFrame:
    """A4: ``TableName, ColumnName, MinValue, MaxValue`` for every numeric
    column, in one scan. An empty table gives null min/max."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, types)]
    out_schema = "TableName string, ColumnName string, MinValue {0}, MaxValue {0}"
    vt = value_type or (_common_type(fields) if fields else "double")
    if not fields:
        return df.sparkSession.createDataFrame([], out_schema.format(vt))
    aggs = []
    for i, f in enumerate(fields):
        aggs += [F.min(F.col(_q(f.name))).cast(vt).alias(f"_mn{i}"),
                 F.max(F.col(_q(f.name))).cast(vt).alias(f"_mx{i}")]
    wide = df.agg(*aggs)
    args = ", ".join(f"{_sql_str(table_name)}, {_sql_str(f.name)}, _mn{i}, _mx{i}"
                     for i, f in enumerate(fields))
    return wide.selectExpr(f"stack({len(fields)}, {args}) as (TableName, ColumnName, MinValue, MaxValue)")


def column_min_max_all(tables: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]],
                       value_type: str | None = None, batch: int = BATCH) -> DataFrame:
    """``column_min_max`` of several tables (names may repeat in different
    schemas), ``UNION ALL``-ed by name, in the common type of all columns; the scans of
    more than ``batch`` tables run ``batch`` at a time."""
    named = list(tables.items()) if isinstance(tables, Mapping) else list(tables)
    if not named:
        raise ValueError("no tables")
    fields = [f for _, df in named for f in df.schema.fields if isinstance(f.dataType, MIN_MAX_TYPES)]
    value_type = value_type or (_common_type(fields) if fields else "double")
    frames = ((lambda n=name, d=df: column_min_max(d, n, value_type)) for name, df in named)
    return in_batches(named[0][1].sparkSession, frames, f"TableName string, ColumnName string, MinValue {value_type}, MaxValue {value_type}", batch)


STATS_SCHEMA = ("column_name string, data_size double, distinct_values_count double, "
                "nulls_fraction double, row_count double, low_value double, high_value double")


def _distinct_text(f: T.StructField):
    """A text form of a value that is equal exactly when the values are
    (``-0.0`` folds into ``0.0`` as in Spark's distinct; binary as hex;
    nested values as JSON, whose text is unambiguous)."""
    c = F.col(_q(f.name))
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0)).cast("string")
    if isinstance(f.dataType, T.BinaryType):
        return F.hex(c)
    if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def exact_distinct_counts(df: DataFrame) -> DataFrame:
    """``(_i, _nd)``: exact distinct non-null values of column ``_i``.

    Every row becomes (column index, value text) pairs; a first aggregate
    removes duplicates (partially on each task), a second counts per column.
    Cheaper than Spark's plan for several ``count(DISTINCT)`` (an ``Expand``
    of each row into one wide row per distinct column)."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), _distinct_text(f).alias("v"))
                      for i, f in enumerate(df.schema.fields)])
    p = df.select(F.explode(pairs).alias("p")).select("p.i", "p.v").where(F.col("v").isNotNull())
    return (p.groupBy("i", "v").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(F.col("i").alias("_i")).agg(F.count(F.lit(1)).alias("_nd")))


def column_stats(df: DataFrame, schema_name: str | None = None, table_name: str | None = None,
                 exact: bool = False, rsd: float = 0.05) -> DataFrame:
    """A5: ``SHOW STATS`` layout for every column plus a summary row.

    Per column: ``data_size`` (bytes, text columns only),
    ``distinct_values_count``, ``nulls_fraction``, ``low_value`` /
    ``high_value`` (numeric columns, as double); ``row_count`` only on the
    summary row (``column_name`` null). Tagged with ``schema_name`` and
    ``table_name`` when given (P8).

    ``exact=False`` uses HyperLogLog++ (``approx_count_distinct``): one pass,
    mergeable partial aggregates. ``exact=True`` counts distinct values
    exactly (``exact_distinct_counts``, a second pass over the table that
    shuffles its distinct (column, value) pairs): for checks and small
    tables."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        c = F.col(_q(f.name))
        aggs.append(F.count(c).alias(f"_nn{i}"))
        nd = F.lit(None).cast("long") if exact else F.approx_count_distinct(c, rsd)
        aggs.append(nd.alias(f"_nd{i}"))
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            aggs.append(F.sum(F.octet_length(c)).cast("double").alias(f"_ds{i}"))
        else:
            aggs.append(F.lit(None).cast("double").alias(f"_ds{i}"))
        if isinstance(f.dataType, NUMERIC_TYPES):
            aggs += [F.min(c).cast("double").alias(f"_lo{i}"), F.max(c).cast("double").alias(f"_hi{i}")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"_lo{i}"), F.lit(None).cast("double").alias(f"_hi{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, f in enumerate(fields):
        rows.append(f"{i}, {_sql_str(f.name)}, _ds{i}, cast(_nd{i} as double), "
                    f"case when _n = 0 then null else (_n - _nn{i}) / _n end, "
                    f"cast(null as double), _lo{i}, _hi{i}")
    rows.append("-1, cast(null as string), cast(null as double), cast(null as double), cast(null as double), "
                "cast(_n as double), cast(null as double), cast(null as double)")
    out = wide.selectExpr(
        f"stack({len(rows)}, {', '.join(rows)}) as (_col, column_name, data_size, distinct_values_count, "
        "nulls_fraction, row_count, low_value, high_value)")
    if exact:
        counts = exact_distinct_counts(df)
        out = (out.join(counts, F.col("_col") == F.col("_i"), "left")
               .withColumn("distinct_values_count",
                           F.when(F.col("_col") >= 0, F.coalesce(F.col("_nd"), F.lit(0)).cast("double"))))
    out = out.select("column_name", "data_size", "distinct_values_count", "nulls_fraction", "row_count",
                     "low_value", "high_value")
    tags = {}
    if schema_name is not None:
        tags["schema_name"] = F.lit(schema_name)
    if table_name is not None:
        tags["table_name"] = F.lit(table_name)
    return out.withColumns(tags) if tags else out


_TAGS = ", schema_name string, table_name string"


def schema_stats(tables: Mapping[str, DataFrame], schema_name: str, exact: bool = False, batch: int = BATCH) -> DataFrame | None:
    """Export ``stats_{schema}``: ``column_stats`` of every table of a schema,
    tagged and unioned by name (U2). One scan per table, ``batch`` tables at a time."""
    if not tables:
        return None
    frames = ((lambda n=name: column_stats(tables[n], schema_name, n, exact)) for name in tables)
    return in_batches(next(iter(tables.values())).sparkSession, frames, STATS_SCHEMA + _TAGS, batch)


def _option(value):
    """What a Scala option holds, or None."""
    return value.get() if value.isDefined() else None


def catalog_statistics(spark: SparkSession, fqn: str) -> tuple[float | None, dict[str, dict[str, float | None]]]:
    """Row count, and by column the statistics that the catalog has of a table, from one
    look-up of its entry (``avg_len``, ``distinct``, ``nulls``, ``min``, ``max``)."""
    state = spark._jsparkSession.sessionState()
    found = _option(state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(fqn)).stats())
    if found is None:
        return None, {}

    def number(option) -> float | None:
        value = _option(option)
        try:
            return None if value is None else float(str(value.toString() if hasattr(value, "toString") else value))
        except ValueError:
            return None
    columns = {}
    entries = found.colStats().iterator()
    while entries.hasNext():
        entry = entries.next()
        c = entry._2()
        columns[entry._1()] = {"avg_len": number(c.avgLen()), "distinct": number(c.distinctCount()), "nulls": number(c.nullCount()),
                               "min": number(c.min()), "max": number(c.max())}
    return number(found.rowCount()), columns


def analyze_table(spark: SparkSession, fqn: str) -> DataFrame:
    """``ANALYZE TABLE ... FOR ALL COLUMNS`` on a catalog table, then read
    the collected statistics back in the ``SHOW STATS`` layout: one statement and one
    look-up, however many columns there are.

    A failed ANALYZE is logged and the stats that exist are still read. The
    result has one row per column (catalog metadata, not data)."""
    try:
        spark.sql(f"ANALYZE TABLE {fqn} COMPUTE STATISTICS FOR ALL COLUMNS")
    except Exception as exc:  # noqa: BLE001 - source behaviour: log and go on
        log.error("ANALYZE %s failed: %s", fqn, exc)
    n_rows, columns = catalog_statistics(spark, fqn)
    rows = []
    for f in spark.table(fqn).schema.fields:
        c = columns.get(f.name, {})
        is_text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        is_num = isinstance(f.dataType, NUMERIC_TYPES)
        nulls = c.get("nulls")
        rows.append((f.name,
                     (c.get("avg_len") or 0.0) * ((n_rows or 0.0) - (nulls or 0.0)) if is_text else None,
                     c.get("distinct"),
                     (nulls / n_rows) if (nulls is not None and n_rows) else None,
                     None,
                     c.get("min") if is_num else None,
                     c.get("max") if is_num else None))
    rows.append((None, None, None, None, n_rows, None, None))
    return spark.createDataFrame(rows, STATS_SCHEMA)


def analyze_schema(spark: SparkSession, schema_name: str, tables: Sequence[str], batch: int = BATCH) -> DataFrame | None:
    """``analyze_table`` of all ``tables`` of a schema, tagged (P8), ``batch`` at a time."""
    if not tables:
        return None
    frames = ((lambda n=name: tag(analyze_table(spark, f"{_q(schema_name)}.{_q(n)}"), schema_name=schema_name, table_name=n)) for name in tables)
    return in_batches(spark, frames, STATS_SCHEMA + _TAGS, batch)
