"""Snowflake exports: live catalog objects, warehouse metering, history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from whlens.operators.catalog import tables_with_views
from whlens.operators.filters import live_rows
from whlens.operators.windows import between_days, in_window

# Catalogs never exported.
EXCLUDED_CATALOGS = ("SNOWFLAKE",)


def live_tables(tables: DataFrame, views: DataFrame,
                excluded: Sequence[str] = EXCLUDED_CATALOGS) -> DataFrame:
    """Export ``tables``: live tables with their view definition."""
    return tables_with_views(tables, views, excluded)


def live_objects(df: DataFrame, catalog_col: str = "table_catalog",
                 excluded: Sequence[str] = EXCLUDED_CATALOGS) -> DataFrame:
    """Exports ``views`` / ``columns`` (``table_catalog``) and ``functions``
    (``function_catalog``): ``deleted IS NULL AND catalog NOT IN (...)``."""
    return live_rows(df, catalog=catalog_col, excluded_catalogs=excluded)


def warehouse_usage(metering: DataFrame, start, end, ts: str = "start_time") -> DataFrame:
    """Export ``warehouse_usage``: ``DATE(start_time) BETWEEN S AND E`` (F2)."""
    return between_days(metering, ts, start, end)


def query_history(history: DataFrame, start, end, ts: str = "end_time") -> DataFrame:
    """Export ``query_history_snowflake``: rows whose *end* time lies in
    [S 00:00:00, E 23:59:59] (F5)."""
    return in_window(history, ts, start, end, "closed_day_second")
