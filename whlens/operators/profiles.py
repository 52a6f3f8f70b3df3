"""Column profiles that grow with the landed files.

Each landed file is read once: what it adds to a column's statistics (counts, bytes, least
and greatest value, a HyperLogLog sketch of its distinct values) is kept as a row of a
store, and the statistics of the table are merged from the store. A run reads new files
only; files that have gone drop out of the merge.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.operators.stats import NUMERIC_TYPES, _distinct_text, _q, _sql_str

#: Log2 of a sketch's registers: distinct counts err by about 1.04 / sqrt(2 ** LG_K), 1.6 %.
LG_K = 12
STORE = ("table_name string, file string, position int, column_name string, row_count long, non_null long, data_size double, "
         "low_value double, high_value double, sketch binary")


def file_profiles(df: DataFrame, table_name: str) -> DataFrame:
    """A row of ``STORE`` per (file, column) of ``df``, a bare scan of files, in one scan."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    rows = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(_q(f.name))
        none = F.lit(None).cast("double")
        numeric = isinstance(f.dataType, NUMERIC_TYPES)
        size = F.sum(F.octet_length(c)).cast("double") if isinstance(f.dataType, (T.StringType, T.BinaryType)) else none
        aggs += [F.count(c).alias(f"_nn{i}"), size.alias(f"_ds{i}"), F.hll_sketch_agg(_distinct_text(f), LG_K).alias(f"_sk{i}"),
                 (F.min(c).cast("double") if numeric else none).alias(f"_lo{i}"), (F.max(c).cast("double") if numeric else none).alias(f"_hi{i}")]
        rows.append(f"{i}, {_sql_str(f.name)}, _n, _nn{i}, _ds{i}, _lo{i}, _hi{i}, _sk{i}")
    wide = df.withColumn("_file", F.col("_metadata.file_path")).groupBy("_file").agg(*aggs)
    return wide.selectExpr(f"{_sql_str(table_name)} as table_name", "_file as file",
                           f"stack({len(rows)}, {', '.join(rows)}) as (position, column_name, row_count, non_null, data_size, low_value, high_value, sketch)")


def _files(df: DataFrame) -> list[str]:
    return [re.sub("^file:/+", "file:/", f) for f in df.inputFiles()]


def _stored(spark: SparkSession, store: str) -> DataFrame:
    at = spark._jvm.org.apache.hadoop.fs.Path(store)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(STORE).parquet(store) if there else spark.createDataFrame([], STORE)


def update_profiles(spark: SparkSession, store: str, table_name: str, df: DataFrame,
                    read: Callable[[list[str]], DataFrame] | None = None) -> int:
    """Add the files of ``df`` that ``store`` doesn't have yet; returns how many.

    Only these are read, with ``read`` (paths -> frame; Parquet with ``df``'s schema by
    default). Both lists of files are what the driver holds of a listing anyway. The rows
    arrive as one job commits: a run that fails adds nothing and can be run again."""
    known = {r["file"] for r in _stored(spark, store).where(F.col("table_name") == table_name).select("file").distinct().collect()}
    new = [f for f in _files(df) if f not in known]
    if not new:
        return 0
    from whlens.sources.json_pages import _plain_path
    paths = [_plain_path(f) for f in new]
    frame = read(paths) if read else spark.read.schema(df.schema).parquet(*paths)
    (file_profiles(frame, table_name).repartition(1).write.mode("append").parquet(store))
    return len(new)


def merged_stats(spark: SparkSession, store: str, table_name: str, schema_name: str | None = None, files: list[str] | None = None) -> DataFrame:
    """The ``SHOW STATS`` layout (as ``column_stats``) of all of a table's files in the
    store, or of ``files``: sketches united, counts added."""
    rows = _stored(spark, store).where(F.col("table_name") == table_name)
    if files is not None:
        rows = rows.join(spark.createDataFrame([(f,) for f in files], "file string"), "file", "left_semi")
    whole = rows.groupBy("position", "column_name").agg(
        F.sum("data_size").alias("data_size"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("double").alias("distinct_values_count"),
        F.sum("row_count").alias("n"), F.sum("non_null").alias("nn"), F.min("low_value").alias("low_value"), F.max("high_value").alias("high_value"))
    columns = whole.select("column_name", "data_size", "distinct_values_count", F.when(F.col("n") > 0, (F.col("n") - F.col("nn")) / F.col("n")).alias("nulls_fraction"),
                           F.lit(None).cast("double").alias("row_count"), "low_value", "high_value")
    none = F.lit(None).cast("double")
    total = whole.agg(F.coalesce(F.max("n"), F.lit(0)).cast("double").alias("row_count")).select(
        F.lit(None).cast("string").alias("column_name"), none.alias("data_size"), none.alias("distinct_values_count"), none.alias("nulls_fraction"),
        "row_count", none.alias("low_value"), none.alias("high_value"))
    out = columns.unionByName(total)
    return out.withColumns({"schema_name": F.lit(schema_name), "table_name": F.lit(table_name)}) if schema_name else out
