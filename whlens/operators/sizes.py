"""Sizes of tables and databases from their files.

Files and bytes come from a listing that reads no content, rows from a scan of no column:
of Parquet it reads the footers only. Both run on executors; tables are taken in batches,
so the plan stays small however many there are.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from whlens.operators.batches import BATCH, in_batches
from whlens.operators.nested import tag

SIZES = "table_name string, files long, bytes long, row_count long"


def file_sizes(df: DataFrame) -> DataFrame:
    """(file, bytes, row_count) of every file that ``df``, a scan of files, reads; files
    without rows too. Filters of ``df`` would count, so give the bare scan."""
    spark = df.sparkSession
    names = df.inputFiles()
    rows = df.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("row_count"))
    if not names:
        return rows.select("file", F.lit(0).cast("long").alias("bytes"), "row_count").where("false")
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(n)) for n in names]
    listed = spark.read.format("binaryFile").load(plain).select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    return listed.join(rows, "file", "left").select("file", "bytes", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def table_size(df: DataFrame) -> DataFrame:
    """One row: (files, bytes, row_count)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return file_sizes(df).agg(F.count(F.lit(1)).alias("files"), total("bytes"), total("row_count"))


def table_sizes(spark: SparkSession, tables: Mapping[str, DataFrame], batch: int = BATCH) -> DataFrame:
    """(table_name, files, bytes, row_count) of each of ``tables`` (name -> scan)."""
    frames = ((lambda n=n: tag(table_size(tables[n]), table_name=n).select("table_name", "files", "bytes", "row_count")) for n in tables)
    return in_batches(spark, frames, SIZES, batch)


def database_size(sizes: DataFrame, **names) -> DataFrame:
    """One row for all of ``sizes``: (tables, files, bytes, row_count), tagged with ``names``."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return tag(sizes.agg(F.count(F.lit(1)).alias("tables"), total("files"), total("bytes"), total("row_count")), **names)
