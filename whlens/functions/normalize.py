"""Timestamp and value normalisation applied before export.

All are column expressions (no Python UDF), so they stay in whole-stage
codegen next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_utc(df: DataFrame) -> None:
    """Zone casts (N1) and epoch arithmetic on zone-less times (N2) go through
    the session time zone; results are UTC wall times only in a UTC session
    (``whlens.session.build_session`` and the registered queries set it)."""
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {tz!r}; set it to 'UTC' for whlens exports")


def _ts_columns(df: DataFrame, kinds=(T.TimestampType, T.TimestampNTZType)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def utc_naive(df: DataFrame) -> DataFrame:
    """Zoned timestamps to UTC wall time without zone.

    With the session zone pinned to UTC (see ``whlens.session``) a cast to
    ``timestamp_ntz`` yields the UTC wall clock."""
    cols = _ts_columns(df, (T.TimestampType,))
    if not cols:
        return df
    require_utc(df)
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in cols})


def round_half_even_ms(c: Column, kind: str = "timestamp_ntz") -> Column:
    """N2 for one column: round to the millisecond, ties to even (as pandas
    ``dt.round("ms")``). Integer arithmetic on epoch microseconds; correct
    before 1970 too (``pmod`` keeps the remainder non-negative)."""
    us = F.unix_micros(c.cast("timestamp"))
    r = F.pmod(us, F.lit(1000))
    # (us - r) is a multiple of 1000; divide as decimal so the quotient is
    # exact for every representable timestamp (doubles stop at 2**53 us).
    q = ((us - r).cast("decimal(20,0)") / F.lit(1000)).cast("long")
    up = (r > 500) | ((r == 500) & (F.pmod(q, F.lit(2)) == 1))
    q2 = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.timestamp_micros(q2 * F.lit(1000)).cast(kind)


def round_ms(df: DataFrame) -> DataFrame:
    """N2 on every timestamp column of ``df``."""
    if _ts_columns(df):
        require_utc(df)
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = round_half_even_ms(F.col(f"`{f.name}`"), f.dataType.simpleString())
    return df.withColumns(out) if out else df


def iso_text(c: Column) -> Column:
    """Python ``isoformat`` text; fraction only when non-zero; null -> ''."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return (F.when(c.isNull(), F.lit(""))
            .when(frac == "000000", whole)
            .otherwise(F.concat(whole, F.lit("."), frac)))


def iso_text_columns(df: DataFrame) -> DataFrame:
    """N5 on every timestamp column."""
    cols = _ts_columns(df)
    return df.withColumns({c: iso_text(F.col(f"`{c}`")) for c in cols}) if cols else df


def hour_label(c: Column) -> Column:
    """``%Y%m%d_%H`` label of the hour a time falls in."""
    return F.date_format(c, "yyyyMMdd_HH")


def epoch_ms(c: Column) -> Column:
    """Milliseconds since the epoch (UTC)."""
    return F.unix_millis(c.cast("timestamp"))


def from_epoch_ms(c: Column) -> Column:
    """Epoch milliseconds to a UTC timestamp without zone."""
    return F.timestamp_millis(c).cast("timestamp_ntz")


def normalize_for_export(df: DataFrame) -> DataFrame:
    """N1 then N2: what every export gets before it is written."""
    return round_ms(utc_naive(df))
