"""Trino / Starburst exports: catalog columns, schema statistics, history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.operators.nested import json_text
from whlens.operators.stats import schema_stats
from whlens.operators.windows import in_window
from whlens.sources.catalog import catalog_columns
from whlens.sources.files import scan_capped

# Starburst history columns exported as text.
TEXT_COLUMNS = ("session_properties", "create_time", "execution_start_time", "end_time")


def timestamp_text(c: Column) -> Column:
    """Text of a timestamp as ``str()`` of a pandas timestamp: fraction only
    when non-zero, null -> ``NaT``."""
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return (F.when(c.isNull(), F.lit("NaT")).when(frac == "000000", whole)
            .otherwise(F.concat(whole, F.lit("."), frac)))


def as_text(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Maps / structs to JSON text, timestamps to text, others cast."""
    out = {}
    for f in df.schema.fields:
        if f.name not in columns:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)):
            out[f.name] = json_text(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = timestamp_text(c)
        else:
            out[f.name] = c.cast("string")
    return df.withColumns(out) if out else df


def query_history(history: DataFrame, start, end, date_col: str = "date") -> DataFrame:
    """Export ``query_history_starburst``: text ``date`` BETWEEN 'S' AND 'E'
    (lexical, F6), four columns as text (C12)."""
    return as_text(in_window(history, date_col, start, end, "text_between"))


def schema_info(columns: DataFrame, catalog: str) -> DataFrame:
    """Export ``schema_info_{catalog}``."""
    return catalog_columns(columns, catalog)


def stats(tables: Mapping[str, DataFrame], schema: str, exact: bool = False) -> DataFrame:
    """Export ``stats_{schema}``."""
    return schema_stats(tables, schema, exact)


def trino_history(history: DataFrame, cap: int | None = None, start=None, end=None,
                  ts: str = "created") -> DataFrame:
    """Export ``query_history_trino``: the whole history table (the source's
    unordered row cap only if ``cap`` is given); the window is optional (the source parses the dates
    but does not apply them)."""
    if start is not None:
        history = in_window(history, ts, start, end, "half_open_days")
    return scan_capped(history.sparkSession, history, cap)
