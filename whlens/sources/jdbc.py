"""JDBC reads of live system tables.

Read from a warehouse that speaks JDBC. The bounded-slice form turns the
hour loop of a history export into ``predicates``: one half-open slice per
hour, and each slice becomes one partition read in parallel by the executors
(instead of one hour after another through a single client).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_scan(spark: SparkSession, url: str, query: str,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    """Run a SQL text on the source and get a named-column DataFrame."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def hour_slices(start, end, step: dt.timedelta = dt.timedelta(hours=1)) -> list[tuple[dt.datetime, dt.datetime]]:
    """Half-open slices ``[t, t+step)`` covering ``[start, end)``."""
    t = start
    out = []
    while t < end:
        out.append((t, min(t + step, end)))
        t += step
    return out


def slice_predicates(ts_col: str, start, end, step: dt.timedelta = dt.timedelta(hours=1)) -> list[str]:
    """WHERE clauses of the slices, with ``TIMESTAMP`` literals."""
    f = "%Y-%m-%d %H:%M:%S"
    return [f"{ts_col} >= TIMESTAMP '{a.strftime(f)}' AND {ts_col} < TIMESTAMP '{b.strftime(f)}'"
            for a, b in hour_slices(start, end, step)]


def sliced_scan(spark: SparkSession, url: str, table: str, ts_col: str, start_day, end_day,
                step: dt.timedelta = dt.timedelta(hours=1),
                properties: Mapping[str, str] | None = None) -> DataFrame:
    """S3: ``table`` rows with ``ts_col`` in ``[S 00:00, E+1d 00:00)``, read as
    one partition per slice. The slices are disjoint and cover the window."""
    from whlens.operators.windows import parse_day
    s = dt.datetime.combine(parse_day(start_day), dt.time())
    e = dt.datetime.combine(parse_day(end_day) + dt.timedelta(days=1), dt.time())
    props = dict(properties or {})
    return spark.read.jdbc(url, table, predicates=slice_predicates(ts_col, s, e, step),
                           properties=props)
