"""Version-valid joins and version windows (usage cost, warehouse events).

* ``version_intervals`` (W1): next change time per key via ``lead`` (per
  key and day bucket when the version table is large). Both forms give the
  same values, null change times included.
* ``latest_per_key`` (W2): newest row per key; Spark plans a partial
  ``WindowGroupLimit`` before the shuffle, so hot keys are cut to one row per
  map task before they move.
* ``temporal_join`` (J4/J5): equi keys plus a validity range. Two physical
  forms, picked by the estimated size of the version side:

  - small version side: broadcast hash join on the equi keys with the range
    as join condition (no shuffle of the fact side at all);
  - large version side: one sorted stream of facts and versions
    (``whlens.operators.intervals``), or, with a ``bucket`` given, a join on
    time buckets: both sides get a bucket. Versions are exploded over the buckets they cover (clipped to the
    buckets the facts span), facts get their own bucket; the equi-join runs
    on ``keys + bucket`` with the range re-checked. A hot key is spread over
    its days instead of landing in one task, and a key with many versions
    only meets the versions of one day; AQE splits what is still skewed.

  Each (fact, version) pair occurs once in either form: a fact has one
  bucket, a version occurs once per bucket. Boundary duplicates of ``closed="both"`` are
  therefore kept exactly as the SQL semantics define them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from whlens.operators.intervals import sorted_interval_join
from whlens.operators.joins import DEFAULT_BROADCAST_BYTES, fits_broadcast

KeyPairs = Sequence[tuple[str, str]]


def _pairs(on) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


BUCKETS = ("day", "week", "month", "year")


def _bucket(c: Column, unit: str) -> Column:
    return F.to_date(c) if unit == "day" else F.date_trunc(unit, c).cast("date")


def _next_time(ts: str, keys: Sequence[str]) -> Column:
    """The next non-null time in the order of ``ts`` within ``keys``."""
    return F.expr(f"lead(`{ts}`) ignore nulls over (partition by {', '.join(f'`{k}`' for k in keys)} order by `{ts}`)")


def version_intervals(df: DataFrame, keys: Sequence[str], ts: str,
                      open_end=None, out: str = "next_change_time",
                      plain_max_bytes: int | None = DEFAULT_BROADCAST_BYTES, bucket: str = "day",
                      small: bool | None = None) -> DataFrame:
    """Add ``out`` = next ``ts`` of the same key, the last version ends at
    ``open_end`` (default ``current_timestamp()``), cast to ``ts``'s type. Null
    times come first and end at the key's first time.

    A version table estimated at ``plain_max_bytes`` or less uses one ``lead``
    window per key. A larger one is processed per (key, ``bucket``): ``lead``
    inside each bucket, and the first change of the next non-empty bucket of
    the key (a window over one row per key and bucket) for the last row of a
    bucket. No task then holds more than one key-bucket of versions.
    ``small`` gives the size verdict when the caller already has it."""
    ts_type = df.schema[ts].dataType
    if open_end is None:
        end = F.current_timestamp()
    elif isinstance(open_end, Column):
        end = open_end
    else:
        end = F.lit(open_end)
    if small if small is not None else fits_broadcast(df, plain_max_bytes):
        return df.withColumn(out, F.coalesce(_next_time(ts, keys), end.cast(ts_type)))
    b = "_vi_bucket"
    d = df.withColumn(b, _bucket(F.col(ts), bucket))
    inside = d.withColumn("_vi_next", _next_time(ts, [*keys, b]))
    firsts = d.groupBy(*[F.col(k).alias(f"_vi_k{i}") for i, k in enumerate(keys)], F.col(b).alias("_vi_b")) \
        .agg(F.min(ts).alias("_vi_first"))
    kcols = [f"_vi_k{i}" for i in range(len(keys))]
    nxt = firsts.withColumn("_vi_next_first",
                            F.lead("_vi_first").over(Window.partitionBy(*kcols).orderBy("_vi_b")))
    cond = F.col(b).eqNullSafe(F.col("_vi_b"))
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(kcols[i]))
    joined = inside.join(nxt, cond, "left")
    return (joined.withColumn(out, F.coalesce(F.col("_vi_next"), F.col("_vi_next_first"), end.cast(ts_type)))
            .select(*df.columns, out))


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                   tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Keep the newest row of every key (``row_number() ... desc = 1``).

    ``DESC`` sorts nulls last, as in the warehouse SQL; ``tie_breakers`` make
    the choice among equal times deterministic."""
    order = [F.col(ts).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _range_condition(at: Column, start: Column, end: Column, closed: str) -> Column:
    if closed == "left":
        # half-open, open-ended last version: start <= at < end (end null = open)
        return (at >= start) & (end.isNull() | (at < end))
    if closed == "both":
        return at.between(start, end)
    raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")


def temporal_join(facts: DataFrame, versions: DataFrame, on, at: str, start: str,
                  end: str, how: str = "inner", closed: str = "left",
                  broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES, bucket: str | None = None,
                  facts_alias: str = "f", versions_alias: str = "v", small: bool | None = None,
                  within=None) -> DataFrame:
    """Join every fact to the version(s) valid at ``facts[at]``.

    ``on`` lists equi keys as names (same on both sides) or ``(fact, version)``
    pairs. ``how`` is ``inner`` or ``facts_left`` (facts without a valid
    version kept with nulls). The result keeps both aliases, so callers select
    ``f.*`` / ``v.col``. A large version side is joined as a sorted stream, or by
    time buckets if ``bucket`` names them: ``day`` spreads hot keys most; ``month`` / ``year`` keep the
    exploded version side small when versions live for years. ``small``
    gives the size verdict of ``versions`` when the caller already has it.
    ``within``: the (first, last) day of all ``at``, or a frame that has every
    ``at`` and is cheaper to scan than ``facts`` (its bounds are then a scalar
    subquery); ``facts`` itself by default.
    """
    if how not in ("inner", "facts_left"):
        raise ValueError("how must be 'inner' or 'facts_left'")
    if bucket is not None and bucket not in BUCKETS:
        raise ValueError(f"bucket must be one of {BUCKETS}")
    join_type = "inner" if how == "inner" else "left"
    pairs = _pairs(on)
    f = facts.alias(facts_alias)
    v = versions.alias(versions_alias)
    fc = lambda c: F.col(f"{facts_alias}.{c}")
    vc = lambda c: F.col(f"{versions_alias}.{c}")
    rng = _range_condition(fc(at), vc(start), vc(end), closed)

    if small if small is not None else fits_broadcast(versions, broadcast_max_bytes):
        cond = rng
        for a, b in pairs:
            cond = cond & (fc(a) == vc(b))
        return f.join(F.broadcast(v), cond, join_type)

    if bucket is None:
        return sorted_interval_join(facts, versions, pairs, at, start, end, how, closed, facts_alias, versions_alias)

    # Large version side: time buckets, clipped to those that the facts span.
    # Without facts the bounds are null and nothing is exploded.
    if isinstance(within, tuple):
        lo, hi = (_bucket(F.lit(d).cast("date"), bucket) for d in within)
    else:
        span = (facts if within is None else within).agg(F.min(_bucket(F.col(at), bucket)).alias("lo"),
                                                         F.max(_bucket(F.col(at), bucket)).alias("hi"))
        lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    key = "_whl_bucket"
    f_b = facts.withColumn(key, _bucket(F.col(at), bucket)).alias(facts_alias)
    first = F.when(lo.isNotNull(), F.greatest(_bucket(F.col(start), bucket), lo))
    last = F.when(hi.isNotNull(), F.least(F.coalesce(_bucket(F.col(end), bucket), hi), hi))
    step = F.expr(f"interval 1 {bucket}")
    v_b = versions.where(first <= last).withColumn(key, F.explode(F.sequence(first, last, step)))
    v_b = v_b.alias(versions_alias)
    cond = rng & (F.col(f"{facts_alias}.{key}") == F.col(f"{versions_alias}.{key}"))
    for a, b in pairs:
        cond = cond & (fc(a) == vc(b))
    joined = f_b.join(v_b, cond, join_type)
    return joined.drop(F.col(f"{facts_alias}.{key}")).drop(F.col(f"{versions_alias}.{key}"))
