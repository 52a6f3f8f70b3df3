"""Databricks exports: usage cost, warehouse events, warehouse info, query
history (hourly and REST-page forms)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whlens.functions.normalize import hour_label
from whlens.operators.filters import exclude_text
from whlens.operators.joins import fits_broadcast, quantile_order
from whlens.operators.nested import field, field_or_null
from whlens.operators.temporal import latest_per_key, temporal_join, version_intervals
from whlens.operators.windows import between_dates, in_window, parse_day
from whlens.sources.json_pages import HISTORY_METRICS


def usage_with_warehouse(usage: DataFrame, warehouses: DataFrame,
                         latest_name: bool = False) -> DataFrame:
    """J1 + A1: usage rows with their warehouse name.

    Joined on (account, workspace, ``usage_metadata.warehouse_id``) to the
    ``DISTINCT`` (account, workspace, warehouse, name) of the warehouse
    versions. A renamed warehouse has two names, so its usage appears twice
    (source semantics); ``latest_name=True`` keeps only the newest name.
    The warehouse side is a dimension: broadcast if it is estimated small."""
    w = warehouses
    if latest_name:
        w = latest_per_key(w, ["account_id", "workspace_id", "warehouse_id"], "change_time",
                           ["warehouse_name"])
    w = w.select(F.col("account_id").alias("w_account_id"),
                 F.col("workspace_id").alias("_w_workspace_id"),
                 F.col("warehouse_id").alias("_w_warehouse_id"),
                 "warehouse_name")
    small = fits_broadcast(w)        # the distinct rows are at most these
    w = w.distinct()
    cond = ((F.col("account_id") == F.col("w_account_id"))
            & (F.col("workspace_id") == F.col("_w_workspace_id"))
            & (field("usage_metadata.warehouse_id") == F.col("_w_warehouse_id")))
    return usage.join(F.broadcast(w) if small else w, cond, "inner").select(
        *[F.col(f"`{c}`") for c in usage.columns], "warehouse_name")


def usage_cost(usage: DataFrame, warehouses: DataFrame, list_prices: DataFrame,
               start, end, today=None, product: str = "SQL", currency: str = "USD",
               keep_unpriced: bool = False, latest_name: bool = False, ordered: bool = True,
               bucket: str | None = None, broadcast_max_bytes: int | None = None) -> DataFrame:
    """Export ``usage``: SQL-warehouse usage priced at the list price valid
    when the usage ended.

    * usage of ``product`` with ``usage_date`` in [start, end] (F8, F1),
      joined to warehouse names (J1);
    * temporal join to the ``currency`` prices on (sku, unit) with
      ``price_start <= usage_end < price_end`` (open-ended last price) (J4);
    * ``usage_usd = coalesce(quantity * price, 0)`` (C2) and the price end
      coalesced to ``today + 1 day`` (C1, C3; ``today`` defaults to
      ``current_date()``);
    * the source writes ``prices LEFT JOIN usage ... WHERE account_id IS NOT
      NULL``: an inner join (J6), so usage without a price is dropped;
      ``keep_unpriced=True`` keeps it with a zero cost;
    * ordered by ``usage_start_time`` (O1), partitioned at quantiles of the usage
      rows' own times, so the join runs once; ``ordered=False`` returns the same
      rows without the order.

    ``bucket`` and ``broadcast_max_bytes`` are those of ``temporal_join``: prices
    that are valid for years make fewer rows per ``month`` or ``year``.
    """
    u = between_dates(usage.where(F.col("billing_origin_product") == product),
                      "usage_date", start, end)
    cte = usage_with_warehouse(u, warehouses, latest_name)
    prices = list_prices.where(F.col("currency_code") == currency)
    j = temporal_join(cte, prices, ["sku_name", "usage_unit"], "usage_end_time",
                      "price_start_time", "price_end_time",
                      how="facts_left" if keep_unpriced else "inner", closed="left",
                      bucket=bucket, broadcast_max_bytes=broadcast_max_bytes, within=u.select("usage_end_time"))
    today_col = F.current_date() if today is None else F.lit(today).cast("date")
    end_type = prices.schema["price_end_time"].dataType
    price = F.col("v.pricing").getField("effective_list").getField("default")
    out = j.select(
        F.coalesce(F.col("v.price_end_time"), F.date_add(today_col, 1).cast(end_type))
        .alias("coalesced_price_end_time"),
        F.col("v.price_start_time"), F.col("v.currency_code"), price.alias("price_per_unit"),
        *[F.col(f"f.`{c}`") for c in cte.columns],
        F.coalesce(F.col("f.usage_quantity") * price, F.lit(0)).alias("usage_usd"))
    out = out.where(F.col("account_id").isNotNull())
    return quantile_order(out, "usage_start_time", u.select("usage_start_time")) if ordered else out


def warehouse_events(events: DataFrame, warehouses: DataFrame, start, end,
                     open_end=None, closed: str = "both", ordered: bool = True, bucket: str | None = None,
                     broadcast_max_bytes: int | None = None) -> DataFrame:
    """Export ``event``: warehouse events inside a version interval of their
    warehouse, events of the window days, newest first.

    Version intervals come from W1 (``lead`` per warehouse id, last one open
    to ``open_end``). ``closed="both"`` is the source's ``BETWEEN``: an event
    exactly at a change time matches both versions and appears twice;
    ``closed="left"`` gives at most one match. ``ordered=False`` skips the
    final global order (newest first). ``bucket`` and ``broadcast_max_bytes`` are
    those of ``temporal_join``; the window gives its bounds."""
    ev = in_window(events, "event_time", start, end, "date_between")
    versions = warehouses.select("warehouse_id", "change_time")
    small = fits_broadcast(versions, broadcast_max_bytes)   # the intervals have exactly these rows
    iv = version_intervals(versions, ["warehouse_id"], "change_time", open_end, small=small, bucket=bucket or "day")
    j = temporal_join(ev, iv, ["warehouse_id"], "event_time", "change_time", "next_change_time",
                      how="inner", closed=closed, small=small, bucket=bucket,
                      within=(parse_day(start), parse_day(end)))
    out = j.select(*[F.col(f"f.`{c}`") for c in events.columns])
    return quantile_order(out, "event_time", ev.select("event_time"), descending=True) if ordered else out


def warehouse_info(warehouses: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Export ``warehouse_info``: newest version of every (warehouse,
    workspace, account, name) (W2, P4: ``* EXCEPT (rn)``)."""
    return latest_per_key(warehouses, ["warehouse_id", "workspace_id", "account_id", "warehouse_name"],
                          "change_time", tie_breakers)


def hourly_history(history: DataFrame, start, end, ts: str = "start_time") -> DataFrame:
    """Export ``query_history_YYYYMMDD_HH`` before writing: rows of
    [S 00:00, E+1d 00:00) with the ``hour`` label the writer partitions by
    (S3, F3, C8). The hour slices are disjoint and cover the window."""
    return in_window(history, ts, start, end, "half_open_days").withColumn("hour", hour_label(F.col(ts)))


# Text markers of generated statements the REST export drops.
SYSTEM_QUERY_MARKERS = ("This is a system generated query from sql editor",)
INFORMATION_SCHEMA_MARKERS = ("SELECT * FROM system.information_schema",
                              "SET use_cached_result = false ")

# Output names of the REST export, in order, and their source.
REST_TOP_LEVEL = [("query_id", "query_id"), ("query_text", "query_text"), ("user_id", "user_id"),
                  ("user", "user_name"), ("start_time", "query_start_time_ms"),
                  ("end_time", "execution_end_time_ms"), ("status", "status")]


def project_history(records: DataFrame) -> DataFrame:
    """The fixed 29-column layout (7 top-level fields, 22 metrics);
    absent fields read as null."""
    cols = [field_or_null(records, src).alias(dst) for dst, src in REST_TOP_LEVEL]
    cols += [field_or_null(records, f"metrics.{n}", t.simpleString()).alias(n) for n, t in HISTORY_METRICS]
    return records.select(*cols)


def rest_history(records: DataFrame, start=None, end=None, status: str = "FINISHED") -> DataFrame:
    """Export ``query_history_output``: REST history records of the window
    (epoch-ms closed, F7), ``status`` only (F8), generated statements
    dropped (F12), projected to 29 columns (P7)."""
    r = records.where(F.col("status") == status)
    if start is not None:
        r = in_window(r, "query_start_time_ms", start, end, "epoch_ms_closed")
    r = exclude_text(r, "query_text", SYSTEM_QUERY_MARKERS + INFORMATION_SCHEMA_MARKERS)
    return project_history(r)

