"""Date/time window predicates of the history exports.

Every warehouse bounds its history differently (half-open days, closed at the
midnight instant, closed to 23:59:59, text dates, epoch milliseconds); a wrong
end bound silently loses or gains a day, so the mode is always explicit.

All forms are plain column predicates against literals: Catalyst pushes them
into the Parquet scan (``PushedFilters``) and prunes row groups / partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("half_open_days", "closed_instant", "closed_day_second", "date_between",
         "text_between", "epoch_ms_closed")


def parse_day(value) -> dt.date:
    """``YYYY-MM-DD`` (or a date/datetime) to a date; bad input raises."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(str(value), "%Y-%m-%d").date()


def parse_instant(value) -> dt.datetime:
    """ISO date or date-time, optionally zoned, to a naive UTC datetime."""
    if isinstance(value, dt.datetime):
        d = value
    elif isinstance(value, dt.date):
        d = dt.datetime(value.year, value.month, value.day)
    else:
        d = dt.datetime.fromisoformat(str(value))
    if d.tzinfo is not None:
        d = d.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return d


def _ts_lit(d: dt.datetime, kind: str = "timestamp_ntz") -> Column:
    return F.lit(d.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)


def window_predicate(c: Column, start, end, mode: str, kind: str = "timestamp_ntz") -> Column:
    """Predicate for ``c`` in the window [start, end] under ``mode``.

    ``kind`` is the type of ``c`` for instant modes (``timestamp_ntz`` for
    landed Parquet, ``timestamp`` for zoned warehouse columns).
    """
    if mode == "half_open_days":          # [S 00:00, E+1d 00:00)
        s = dt.datetime.combine(parse_day(start), dt.time())
        e = dt.datetime.combine(parse_day(end) + dt.timedelta(days=1), dt.time())
        return (c >= _ts_lit(s, kind=kind)) & (c < _ts_lit(e, kind=kind))
    if mode == "closed_instant":          # [S, E] with E at midnight unless a time is given
        return c.between(_ts_lit(parse_instant(start), kind=kind),
                         _ts_lit(parse_instant(end), kind=kind))
    if mode == "closed_day_second":       # [S 00:00:00, E 23:59:59]
        s = dt.datetime.combine(parse_day(start), dt.time())
        e = dt.datetime.combine(parse_day(end), dt.time(23, 59, 59))
        return c.between(_ts_lit(s, kind=kind), _ts_lit(e, kind=kind))
    if mode == "date_between":            # DATE(c) BETWEEN S AND E
        return F.to_date(c).between(F.lit(parse_day(start)), F.lit(parse_day(end)))
    if mode == "text_between":            # lexical compare of text dates
        return c.between(F.lit(parse_day(start).isoformat()), F.lit(parse_day(end).isoformat()))
    if mode == "epoch_ms_closed":         # [S ms, (E+1d) ms - 1], UTC
        s = dt.datetime.combine(parse_day(start), dt.time(), tzinfo=dt.timezone.utc)
        e = dt.datetime.combine(parse_day(end) + dt.timedelta(days=1), dt.time(),
                                tzinfo=dt.timezone.utc)
        s_ms = int(s.timestamp() * 1000)
        e_ms = int(e.timestamp() * 1000) - 1
        return c.between(F.lit(s_ms), F.lit(e_ms))
    raise ValueError(f"unknown window mode {mode!r}; one of {MODES}")


def in_window(df: DataFrame, col: str, start, end, mode: str) -> DataFrame:
    """Filter ``df`` to rows whose ``col`` lies in the window."""
    name = col.strip("`")
    kind = df.schema[name].dataType.simpleString() if name in df.schema.fieldNames() else "timestamp_ntz"
    if kind not in ("timestamp", "timestamp_ntz"):
        kind = "timestamp_ntz"
    return df.where(window_predicate(F.col(col), start, end, mode, kind))


def between_dates(df: DataFrame, col: str, start, end) -> DataFrame:
    """a date column BETWEEN two dates, inclusive."""
    return df.where(F.col(col).between(F.lit(parse_day(start)), F.lit(parse_day(end))))


def between_days(df: DataFrame, ts: str, start, end) -> DataFrame:
    """``DATE(ts) BETWEEN S AND E``; Catalyst turns it into a pushed range."""
    return in_window(df, ts, start, end, "date_between")


def range_or_skip(df: DataFrame, path: str, start, end) -> DataFrame:
    """keep records whose nested time exists and lies in the closed
    window; records lacking the field are skipped."""
    c = F.col(path)
    return df.where(c.isNotNull() & window_predicate(c, start, end, "closed_instant"))


def take_until(df: DataFrame, pos: str, ts: str, start, end) -> DataFrame:
    """listing-order early stop.

    In listing order (``pos`` ascending, newest first) records after the
    window end are skipped, the first record older than ``start`` stops the
    listing, and nothing after it is kept even if it lies in the window.
    Records without a time are skipped without stopping.

    The stop position is ``min(pos)`` over the old records: a scalar subquery
    (partial/final aggregate, one value) used as a filter literal. No global
    sort, no single-partition window, no join.
    """
    s = _ts_lit(parse_instant(start))
    e = _ts_lit(parse_instant(end))
    t = F.col(ts)
    stop = df.where(t.isNotNull() & (t < s)).agg(F.min(pos)).scalar()
    return (df.where(F.coalesce(F.col(pos) < stop, F.lit(True)))
            .where(t.isNotNull() & (t <= e) & (t >= s)))
