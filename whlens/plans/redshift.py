"""Redshift exports: catalog (types, aggregates, casts) and query logs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from whlens.operators.catalog import rs_aggregates, rs_casts, rs_types  # noqa: F401 (exports)
from whlens.operators.text import ddl_text, query_text  # noqa: F401 (exports)
from whlens.operators.windows import in_window

# Column lists of the Redshift metric exports.
QUERY_METRICS_COLUMNS = (
    "userid", "service_class", "query", "segment", "step_type", "starttime", "slices", "max_rows", "rows",
    "max_cpu_time", "cpu_time", "max_blocks_read", "blocks_read", "max_run_time", "run_time",
    "max_blocks_to_disk", "blocks_to_disk", "step", "max_query_scan_size", "query_scan_size",
    "query_priority", "query_queue_time", "service_class_name")
QUERY_QUEUE_INFO_COLUMNS = (
    "database", "query", "xid", "userid", "queue_start_time", "exec_start_time", "service_class", "slots",
    "queue_elapsed", "exec_elapsed", "wlm_total_elapsed", "commit_queue_elapsed", "commit_exec_time")
QUERY_WLM_COLUMNS = (
    "userid", "xid", "task", "query", "service_class", "slot_count", "service_class_start_time",
    "queue_start_time", "queue_end_time", "total_queue_time", "exec_start_time", "exec_end_time",
    "total_exec_time", "service_class_end_time", "final_state", "query_priority")


def metric_export(df: DataFrame, columns, ts: str, start, end) -> DataFrame:
    """Exports ``query_metrics`` / ``query_queue_info`` / ``query_wlm``: the
    explicit column list (P1) of rows in the closed window (F4)."""
    return in_window(df, ts, start, end, "closed_instant").select(*columns)


def query_metrics(df: DataFrame, start, end) -> DataFrame:
    return metric_export(df, QUERY_METRICS_COLUMNS, "starttime", start, end)


def query_queue_info(df: DataFrame, start, end) -> DataFrame:
    return metric_export(df, QUERY_QUEUE_INFO_COLUMNS, "queue_start_time", start, end)


def query_wlm(df: DataFrame, start, end) -> DataFrame:
    return metric_export(df, QUERY_WLM_COLUMNS, "queue_start_time", start, end)
