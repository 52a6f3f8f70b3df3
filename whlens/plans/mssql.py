"""SQL Server exports: schema inventory, numeric min/max, query history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from whlens.operators.catalog import numeric_columns, table_schema  # noqa: F401 (exports)
from whlens.operators.stats import column_min_max_all
from whlens.operators.text import apply_text


def column_min_max(tables: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Export ``column_min_max``: min/max of every numeric column of every
    table (A4, U1), one scan per table instead of one per column. Values have the
    common type of all columns: exact decimals unless a floating one is among them."""
    return column_min_max_all(tables)


def query_history(stats: DataFrame, texts: DataFrame, start, end) -> DataFrame:
    """Export ``query_history_mssql``: stats with their statement text
    (lateral apply, J9), creation time closed at both instants (F4)."""
    return apply_text(stats, texts, "sql_handle", start, end, "creation_time")
