"""Incremental exports over landed files with Structured Streaming.

The source exports query history hour by hour over a date range (one bounded
query per hour). Once history is landed continuously as files, the same
export runs incrementally: each run picks up only the files that arrived
since the last run (``Trigger.AvailableNow``), applies the same rows rules
(JSON text for nested columns, UTC millisecond times, ``hour``
label) and appends to the hour folders. The file sink and its checkpoint
make each file count exactly once, across restarts and lost executors.

The REST history pages and the execution batches are exported the same way
(``run_rest_history_export``, ``run_execution_export``).

A stream exports every row of every landed file: a date window would drop rows of
files that are then marked as done. Windows are a batch rule (``plans.exports``).
The checkpoint lies under ``spark.checkpoint.dir``, in a folder of its own for each
(export, source, output).
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from whlens.functions.normalize import hour_label, normalize_for_export
from whlens.operators.nested import nested_to_json
from whlens.session import ensure_checkpoint_dir


def hourly_rows(history: DataFrame, ts: str = "start_time") -> DataFrame:
    """Rows of the hourly export (stream or batch): nested columns as JSON text,
    normalised times, ``hour`` label."""
    out = normalize_for_export(nested_to_json(history))
    return out.withColumn("hour", hour_label(F.col(ts)))


def start_hourly_export(spark: SparkSession, source_dir: str, schema: T.StructType, out_dir: str,
                        ts: str = "start_time", name: str = "query_history",
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an AvailableNow stream from landed Parquet history files to
    ``out_dir`` partitioned by hour; returns the running query (call
    ``awaitTermination()``)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = hourly_rows(reader.parquet(source_dir), ts)
    checkpoint = stream_checkpoint(spark, name, source_dir, out_dir)
    return (rows.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .partitionBy("hour")
            .trigger(availableNow=True)
            .start(out_dir))


def run_hourly_export(spark: SparkSession, source_dir: str, schema: T.StructType, out_dir: str,
                      **kwargs) -> None:
    """Process every history file not yet exported, then return."""
    start_hourly_export(spark, source_dir, schema, out_dir, **kwargs).awaitTermination()


def stream_checkpoint(spark: SparkSession, name: str, source_dir: str, out_dir: str) -> str:
    """The checkpoint of one stream: another source or another output is another
    stream, so two warehouses never share one."""
    own = hashlib.sha256("\n".join((name, source_dir.rstrip("/"), out_dir.rstrip("/"))).encode()).hexdigest()[:24]
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{own}")


def start_file_export(spark: SparkSession, source: DataFrame, source_dir: str, out_dir: str, name: str,
                      partition_by: list[str] | None = None) -> StreamingQuery:
    """Append a streaming DataFrame over the files of ``source_dir`` to ``out_dir``
    with an AvailableNow trigger and a checkpoint under ``spark.checkpoint.dir``."""
    checkpoint = stream_checkpoint(spark, name, source_dir, out_dir)
    writer = (source.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(out_dir)


def run_rest_history_export(spark: SparkSession, pages_dir: str, out_dir: str,
                            name: str = "query_history_output") -> None:
    """The REST history export (pages -> records -> status, generated statements
    dropped, 29 columns) over pages landed since the last run, one on each line. A line
    that is no page fails the run before its files count as done; the batch export reads
    pages of any layout and lists what it can't read."""
    from whlens.plans.databricks import rest_history
    from whlens.sources.json_pages import HISTORY_PAGE, explode_records
    pages = spark.readStream.schema(HISTORY_PAGE).option("mode", "FAILFAST").json(pages_dir)
    rows = normalize_for_export(rest_history(explode_records(pages, "res")))
    start_file_export(spark, rows, pages_dir, out_dir, name).awaitTermination()


def run_execution_export(spark: SparkSession, batches_dir: str, schema: T.StructType, out_dir: str,
                         name: str = "athena_query_logs") -> None:
    """The execution-log export (records with a submission time, flattened, ISO
    text times) over batches landed since the last run, one on each line (others fail the run). A streaming source needs the batch schema up front. The listing-order
    early stop (F15) needs the whole listing and stays a batch rule."""
    from whlens.plans.athena import query_logs
    from whlens.sources.json_pages import explode_records
    batches = spark.readStream.schema(schema).option("mode", "FAILFAST").json(batches_dir)
    start_file_export(spark, query_logs(explode_records(batches, "QueryExecutions")),
                      batches_dir, out_dir, name).awaitTermination()
