"""Checked queries: every export / operator of the inventory applied to the
test-table roles, one callable ``(spark, sf_dir) -> DataFrame`` per name.

Parameters (windows, open ends, ``today``) are fixed so that the results are
deterministic and comparable with the DuckDB texts in ``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.functions.normalize import iso_text, round_half_even_ms, utc_naive
from whlens.operators import catalog as cat
from whlens.operators import nested as nst
from whlens.operators import stats as st
from whlens.operators import text as txt
from whlens.operators.filters import exclude_text, live_rows, visible_objects
from whlens.operators.profiles import merged_stats, update_profiles
from whlens.operators.sizes import database_size, table_sizes
from whlens.operators.temporal import version_intervals
from whlens.operators.windows import between_dates, in_window, range_or_skip, take_until
from whlens.plans import athena, databricks as dbx, mssql, redshift, roles, snowflake, starburst
from whlens.session import shared_dir
from whlens.sinks.writers import hourly_ledger, write_csv, write_export, write_hourly
from whlens.sources.catalog import catalog_columns
from whlens.sources.files import TableSet, scan, scan_capped
from whlens.sources.json_pages import ingest, read_history_pages

# Fixed check parameters.
USAGE_START, USAGE_END, TODAY = "1996-01-01", "1999-12-31", "2029-12-31"
EV_START, EV_END = "2024-01-05", "2024-01-10"
OPEN_END = "2030-01-01 00:00:00"
EMPTY_DAY = "2031-01-01"
STATS_START, STATS_END = "1996-01-01", "1996-12-31"
TEXT_START, TEXT_END = "2024-01-05", "2024-01-25"
DDL_START, DDL_END = "2024-01-03", "2024-01-20"
PROFILE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                  "embeddings", "pages", "benchmark", "labels", "conversations")
STATS_SCHEMA = "tpch"
CATALOG = "CAT_1"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        _QUERIES[name] = fn
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet(spark, sf_dir)


def _drop_nested(df: DataFrame) -> DataFrame:
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.MapType))])


# --- scans ---------------------------------------------------------------------

@query("scan_table")
def q_scan_table(spark, d):
    return scan(_t(spark, d), "customer")


@query("history_capped")
def q_history_capped(spark, d):
    return scan_capped(spark, _t(spark, d)["events"])


@query("catalog_columns")
def q_catalog_columns(spark, d):
    return catalog_columns(roles.info_columns(_t(spark, d)), CATALOG)


# --- Databricks ------------------------------------------------------------------

@query("usage_with_warehouse")
def q_usage_with_warehouse(spark, d):
    t = _t(spark, d)
    u = roles.usage(t).where(F.col("billing_origin_product") == "SQL")
    return _drop_nested(dbx.usage_with_warehouse(u, roles.warehouses(t)))


@query("usage_cost")
def q_usage_cost(spark, d):
    t = _t(spark, d)
    out = dbx.usage_cost(roles.usage(t), roles.warehouses(t), roles.list_prices(t),
                         USAGE_START, USAGE_END, today=TODAY)
    return _drop_nested(out)


@query("usage_cost_bucketed")
def q_usage_cost_bucketed(spark, d):
    """``usage_cost`` by time buckets."""
    t = _t(spark, d)
    return _drop_nested(dbx.usage_cost(roles.usage(t), roles.warehouses(t), roles.list_prices(t), USAGE_START, USAGE_END,
                                       today=TODAY, bucket="month", broadcast_max_bytes=0))


@query("usage_cost_sorted")
def q_usage_cost_sorted(spark, d):
    """``usage_cost`` by the sorted stream for large price lists."""
    t = _t(spark, d)
    return _drop_nested(dbx.usage_cost(roles.usage(t), roles.warehouses(t), roles.list_prices(t), USAGE_START, USAGE_END,
                                       today=TODAY, broadcast_max_bytes=0))


def _order_check(df: DataFrame, key: str, descending: bool = False) -> DataFrame:
    """Rows, and pairs of neighbours out of order: within each partition of the
    result, and between the last and first rows of partitions that follow."""
    at = df.select(F.col(key).alias("k"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    wrong = F.col("k") > F.col("before") if descending else F.col("k") < F.col("before")
    inside = (at.withColumn("before", F.lag("k").over(Window.partitionBy("part").orderBy("at")))
              .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.coalesce(wrong, F.lit(False)).cast("long")).alias("inside")))
    ends = at.groupBy("part").agg(F.min_by("k", "at").alias("k"), F.max_by("k", "at").alias("last"))
    between = (ends.withColumn("before", F.lag("last").over(Window.orderBy("part")))
               .agg(F.sum(F.coalesce(wrong, F.lit(False)).cast("long")).alias("between")))
    return inside.select("n_rows", (F.col("inside") + between.select("between").scalar()).alias("out_of_order"))


@query("usage_cost_order")
def q_usage_cost_order(spark, d):
    return _order_check(q_usage_cost(spark, d), "usage_start_time")


@query("warehouse_events_order")
def q_warehouse_events_order(spark, d):
    return _order_check(q_warehouse_events(spark, d), "event_time", descending=True)


@query("table_schema_order")
def q_table_schema_order(spark, d):
    return _order_check(q_table_schema(spark, d), "table_name")


@query("usage_cost_unpriced")
def q_usage_cost_unpriced(spark, d):
    t = _t(spark, d)
    out = dbx.usage_cost(roles.usage(t), roles.warehouses(t), roles.list_prices(t),
                         USAGE_START, USAGE_END, today=TODAY, keep_unpriced=True)
    return _drop_nested(out)


@query("usage_latest_name")
def q_usage_latest_name(spark, d):
    t = _t(spark, d)
    u = roles.usage(t).where(F.col("billing_origin_product") == "SQL")
    return _drop_nested(dbx.usage_with_warehouse(u, roles.warehouses(t), latest_name=True))


@query("usage_window")
def q_usage_window(spark, d):
    u = roles.usage(_t(spark, d), nested=False).where(F.col("billing_origin_product") == "SQL")
    return between_dates(u, "usage_date", USAGE_START, USAGE_END)


@query("struct_access")
def q_struct_access(spark, d):
    t = _t(spark, d)
    u = roles.usage(t)
    return u.select("account_id", nst.field("usage_metadata.warehouse_id").alias("warehouse_id"),
                    "sku_name", "usage_quantity")


@query("price_struct_access")
def q_price_struct_access(spark, d):
    p = roles.list_prices(_t(spark, d))
    return p.select("sku_name", "price_start_time",
                    nst.field("pricing.effective_list.default").alias("price_per_unit"))


@query("version_intervals")
def q_version_intervals(spark, d):
    return version_intervals(roles.warehouse_changes(_t(spark, d)), ["warehouse_id"], "change_time", OPEN_END)


@query("warehouse_events")
def q_warehouse_events(spark, d):
    t = _t(spark, d)
    return dbx.warehouse_events(roles.warehouse_events(t), roles.warehouse_changes(t), EV_START, EV_END,
                                open_end=OPEN_END)


@query("warehouse_events_bucketed")
def q_warehouse_events_bucketed(spark, d):
    """``warehouse_events`` by time buckets."""
    t = _t(spark, d)
    return dbx.warehouse_events(roles.warehouse_events(t), roles.warehouse_changes(t), EV_START, EV_END,
                                open_end=OPEN_END, broadcast_max_bytes=0, bucket="day")


@query("warehouse_events_sorted")
def q_warehouse_events_sorted(spark, d):
    """``warehouse_events`` by the sorted stream for large version tables."""
    t = _t(spark, d)
    return dbx.warehouse_events(roles.warehouse_events(t), roles.warehouse_changes(t), EV_START, EV_END,
                                open_end=OPEN_END, broadcast_max_bytes=0)


@query("warehouse_events_single")
def q_warehouse_events_single(spark, d):
    t = _t(spark, d)
    return dbx.warehouse_events(roles.warehouse_events(t), roles.warehouse_changes(t), EV_START, EV_END,
                                open_end=OPEN_END, closed="left")


@query("warehouse_info")
def q_warehouse_info(spark, d):
    return dbx.warehouse_info(roles.warehouses(_t(spark, d)))


@query("hourly_history")
def q_hourly_history(spark, d):
    return dbx.hourly_history(roles.query_history(_t(spark, d)), EV_START, EV_END, "start_time")


@query("hourly_counts")
def q_hourly_counts(spark, d):
    h = dbx.hourly_history(roles.query_history(_t(spark, d)), EV_START, EV_END, "start_time")
    return h.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))


@query("rest_history")
def q_rest_history(spark, d):
    return dbx.rest_history(roles.rest_records(_t(spark, d)), EV_START, EV_END)


@query("landed_history")
def q_landed_history(spark, d):
    """``rest_history`` from landed JSON: pages on a line, and pages printed over many."""
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    roles.land_history_pages(_t(spark, d), path)
    return dbx.rest_history(read_history_pages(spark, path), EV_START, EV_END)


@query("landed_ledger")
def q_landed_ledger(spark, d):
    """What the ledger says of a landing in which every fifth page is cut off."""
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    roles.land_history_pages(_t(spark, d), path, cut=True)
    ledger = ingest(spark, path, "res", on_unreadable="quarantine").ledger
    return (ledger.where("form <> 'empty'").groupBy("form", "status")
            .agg(*[F.sum(c).cast("long").alias(c) for c in ("pages", "records", "unreadable")]))


@query("hourly_reexport")
def q_hourly_reexport(spark, d):
    """Hours on disk, and as the ledger has them, after two windows, the first of them again
    without its error events, and an empty one."""
    h = roles.query_history(_t(spark, d))
    path = f"{shared_dir(spark)}/query_history-{uuid.uuid4().hex}"
    for day, rows in ((EV_START, h), (EV_END, h), (EV_START, h.where("statement_type <> 'error'")), (EMPTY_DAY, h)):
        write_hourly(dbx.hourly_history(rows, day, day), path, "start_time", window=(day, day))
    files = spark.read.parquet(path).groupBy("hour").agg(F.count(F.lit(1)).alias("n"))
    ledger = (hourly_ledger(spark, path).groupBy("hour").agg(F.max_by("rows", "started").alias("ledger_n"), F.count(F.lit(1)).alias("runs"))
              .where("ledger_n > 0"))
    return files.join(ledger, "hour", "full")


@query("export_parquet")
def q_export_parquet(spark, d):
    """The events written as an export (times in milliseconds, nested columns as JSON) and read back."""
    path = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    write_export(_t(spark, d)["events"].select("event_id", "ts", "value", F.struct("event_type", "user_id").alias("detail")), path, json_nested=True)
    return spark.read.parquet(path)


@query("export_csv")
def q_export_csv(spark, d):
    """The events written as CSV (ISO times, null as empty) and read back as text."""
    path = f"{shared_dir(spark)}/export-{uuid.uuid4().hex}"
    e = _t(spark, d)["events"]
    late = F.when(F.col("event_id") % 3 > 0, F.col("ts"))
    write_csv(e.select(F.col("event_id").cast("string").alias("event_id"), "ts", late.alias("ended"), "event_type"), path)
    back = spark.read.option("header", "true").csv(path)
    return back.select("event_id", "ts", F.coalesce("ended", F.lit("")).alias("ended"), "event_type")


@query("table_sizes")
def q_table_sizes(spark, d):
    """Rows of each table by its files' footers; the database in the row without a name."""
    t = _t(spark, d)
    each = table_sizes(spark, {n: t[n] for n in PROFILE_TABLES})
    whole = database_size(each).select(F.lit(None).cast("string").alias("table_name"), "files", "bytes", "row_count")
    return each.unionByName(whole).select("table_name", "row_count", (F.col("files") >= 1).alias("has_files"), (F.col("bytes") > F.col("files")).alias("has_bytes"))


@query("history_epoch_ms")
def q_history_epoch_ms(spark, d):
    e = _t(spark, d)["events"].select("event_id", F.unix_millis(F.col("ts").cast("timestamp"))
                                      .alias("start_time_ms"), "event_type")
    return in_window(e, "start_time_ms", EV_START, EV_END, "epoch_ms_closed")


@query("exclude_system_queries")
def q_exclude_system_queries(spark, d):
    return exclude_text(_t(spark, d)["documents"], "text", ["License"])


@query("nested_to_json")
def q_nested_to_json(spark, d):
    e = _t(spark, d)["events"].select("event_id", F.struct("event_type", "user_id").alias("detail"))
    return nst.nested_to_json(e)


@query("json_metrics")
def q_json_metrics(spark, d):
    e = _t(spark, d)["events"]
    return e.select("event_id", nst.json_field("props", "$.k", "long").alias("k"))


@query("round_ms")
def q_round_ms(spark, d):
    e = _t(spark, d)["events"]
    return e.select("event_id", round_half_even_ms(F.col("ts")).alias("ts"))


@query("iso_text")
def q_iso_text(spark, d):
    e = _t(spark, d)["events"]
    return e.select("event_id", iso_text(F.col("ts")).alias("ts"))


# --- Snowflake -------------------------------------------------------------------

@query("live_objects")
def q_live_objects(spark, d):
    return live_rows(roles.sf_tables(_t(spark, d)))


@query("live_views")
def q_live_views(spark, d):
    return live_rows(roles.sf_views(_t(spark, d)))


@query("live_functions")
def q_live_functions(spark, d):
    f = roles.sf_tables(_t(spark, d)).withColumnRenamed("table_catalog", "function_catalog")
    return snowflake.live_objects(f, "function_catalog")


@query("tables_with_views")
def q_tables_with_views(spark, d):
    t = _t(spark, d)
    return cat.tables_with_views(roles.sf_tables(t), roles.sf_views(t))


@query("warehouse_usage")
def q_warehouse_usage(spark, d):
    return snowflake.warehouse_usage(_t(spark, d)["events"], EV_START, EV_END, ts="ts")


@query("history_by_end_time")
def q_history_by_end_time(spark, d):
    h = _t(spark, d)["events"].select(F.col("event_id").alias("query_id"), F.col("ts").alias("end_time"),
                                      F.col("event_type").alias("query_type"), "value")
    return snowflake.query_history(h, EV_START, EV_END)


@query("closed_window")
def q_closed_window(spark, d):
    return in_window(roles.query_history(_t(spark, d)), "start_time", EV_START, EV_END, "closed_instant")


# --- Redshift --------------------------------------------------------------------

@query("query_text")
def q_query_text(spark, d):
    t = _t(spark, d)
    return txt.query_text(roles.stl_query(t), roles.stl_querytext(t), TEXT_START, TEXT_END)


@query("query_ddl")
def q_query_ddl(spark, d):
    return txt.ddl_text(roles.ddl_chunks(_t(spark, d)), DDL_START, DDL_END)


@query("query_ddl_raw")
def q_query_ddl_raw(spark, d):
    return txt.ddl_text(roles.ddl_chunks(_t(spark, d)), DDL_START, DDL_END, rtrim=False)


@query("query_metrics")
def q_query_metrics(spark, d):
    return redshift.query_metrics(roles.metric_table(_t(spark, d), roles.QUERY_METRICS_COLUMNS),
                                  STATS_START, STATS_END)


@query("query_queue_info")
def q_query_queue_info(spark, d):
    return redshift.query_queue_info(roles.metric_table(_t(spark, d), roles.QUERY_QUEUE_INFO_COLUMNS),
                                     STATS_START, STATS_END)


@query("query_wlm")
def q_query_wlm(spark, d):
    return redshift.query_wlm(roles.metric_table(_t(spark, d), roles.QUERY_WLM_COLUMNS), STATS_START, STATS_END)


@query("rs_types")
def q_rs_types(spark, d):
    t = _t(spark, d)
    return cat.rs_types(roles.pg_type(t), roles.pg_namespace(t), roles.pg_class(t), roles.pg_description(t))


@query("rs_types_visible")
def q_rs_types_visible(spark, d):
    t = _t(spark, d)
    return cat.rs_types(roles.pg_type(t), roles.pg_namespace(t), roles.pg_class(t), roles.pg_description(t),
                        roles.search_path(t))


@query("rs_aggregates")
def q_rs_aggregates(spark, d):
    t = _t(spark, d)
    return cat.rs_aggregates(roles.pg_proc(t), roles.pg_namespace(t), roles.pg_type(t), roles.pg_description(t))


@query("rs_aggregates_visible")
def q_rs_aggregates_visible(spark, d):
    t = _t(spark, d)
    return cat.rs_aggregates(roles.pg_proc(t), roles.pg_namespace(t), roles.pg_type(t), roles.pg_description(t),
                             roles.search_path(t))


@query("rs_casts")
def q_rs_casts(spark, d):
    t = _t(spark, d)
    return cat.rs_casts(roles.pg_cast(t), roles.pg_proc(t, with_args=False), roles.pg_type(t),
                        roles.pg_namespace(t))


@query("rs_casts_visible")
def q_rs_casts_visible(spark, d):
    t = _t(spark, d)
    return cat.rs_casts(roles.pg_cast(t), roles.pg_proc(t, with_args=False), roles.pg_type(t),
                        roles.pg_namespace(t), roles.search_path(t))


@query("visible_objects")
def q_visible_objects(spark, d):
    t = _t(spark, d)
    ty = cat.with_namespace(roles.pg_type(t).select("oid", "typname", "typnamespace"), "typnamespace",
                            roles.pg_namespace(t))
    return visible_objects(ty, ["typname"], "nspname", roles.search_path(t), tie_breakers=["oid"])


@query("describe_objects")
def q_describe_objects(spark, d):
    t = _t(spark, d)
    ty = roles.pg_type(t).select("oid", "typname")
    return cat.describe_objects(ty, "oid", roles.pg_description(t), "pg_type")


# --- SQL Server ------------------------------------------------------------------

@query("table_schema")
def q_table_schema(spark, d):
    t = _t(spark, d)
    return cat.table_schema(roles.is_tables(t), roles.sys_columns(t), roles.ms_tables(t),
                            roles.ms_partitions(t), roles.ms_schemas(t))


@query("table_schema_by_name")
def q_table_schema_by_name(spark, d):
    """The source's own rule: row counts joined by the table's name only."""
    t = _t(spark, d)
    return cat.table_schema(roles.is_tables(t), roles.sys_columns(t), roles.ms_tables(t), roles.ms_partitions(t), by_schema=False)


@query("table_schema_summed")
def q_table_schema_summed(spark, d):
    t = _t(spark, d)
    return cat.table_schema(roles.is_tables(t), roles.sys_columns(t), roles.ms_tables(t),
                            roles.ms_partitions(t), roles.ms_schemas(t), sum_partitions=True)


@query("numeric_columns")
def q_numeric_columns(spark, d):
    t = _t(spark, d)
    return cat.numeric_columns(roles.ms_tables(t), roles.ms_schemas(t), roles.ms_columns(t), roles.ms_types(t))


@query("query_stats_text")
def q_query_stats_text(spark, d):
    t = _t(spark, d)
    return mssql.query_history(roles.query_stats(t), roles.query_texts(t), STATS_START, STATS_END)


@query("column_min_max")
def q_column_min_max(spark, d):
    return st.column_min_max(_t(spark, d)["lineitem"], "lineitem", "double")


@query("column_min_max_all")
def q_column_min_max_all(spark, d):
    t = _t(spark, d)
    return st.column_min_max_all({n: t[n] for n in PROFILE_TABLES})


# --- Trino / Starburst -------------------------------------------------------------

@query("column_stats_exact")
def q_column_stats_exact(spark, d):
    t = _t(spark, d)
    return st.schema_stats({n: t[n] for n in PROFILE_TABLES}, STATS_SCHEMA, exact=True)


@query("column_stats")
def q_column_stats(spark, d):
    """The form the export uses. Its distinct counts are estimates: in their place
    stands whether each is within four times the stated error of the exact count."""
    tables = {n: _t(spark, d)[n] for n in PROFILE_TABLES}
    est = st.schema_stats(tables, STATS_SCHEMA, exact=False)
    parts = [st.exact_distinct_counts(df).select(F.lit(n).alias("_t"), F.col("_i"), F.col("_nd")) for n, df in tables.items()]
    names = [spark.createDataFrame([(n, i, f.name) for n, df in tables.items() for i, f in enumerate(df.schema.fields)],
                                   "_nt string, _ni int, _nc string")]
    exact = nst.concat_frames(parts).join(names[0], (F.col("_t") == F.col("_nt")) & (F.col("_i") == F.col("_ni")))
    both = est.join(exact, (F.col("table_name") == F.col("_t")) & (F.col("column_name") == F.col("_nc")), "left")
    nd = F.coalesce("_nd", F.lit(0))
    near = F.when(F.col("column_name").isNotNull(), F.abs(F.col("distinct_values_count") - nd) <= 0.2 * nd + 1)
    return both.select("column_name", "data_size", near.alias("distinct_ok"), "nulls_fraction", "row_count", "low_value",
                       "high_value", "schema_name", "table_name")


@query("stats_incremental")
def q_stats_incremental(spark, d):
    """The events' statistics from a store of sketches, to which each of three landings adds
    its files. Distinct counts are checked as in ``column_stats``."""
    path = f"{shared_dir(spark)}/landing-{uuid.uuid4().hex}"
    e = _t(spark, d)["events"]
    for part in range(3):
        e.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{path}/events")
        update_profiles(spark, f"{path}/profiles", "events", spark.read.parquet(f"{path}/events"))
    est = merged_stats(spark, f"{path}/profiles", "events", STATS_SCHEMA)
    names = spark.createDataFrame([(i, f.name) for i, f in enumerate(e.schema.fields)], "_i int, _nc string")
    exact = st.exact_distinct_counts(e).join(names, "_i")
    both = est.join(exact, F.col("column_name") == F.col("_nc"), "left")
    nd = F.coalesce("_nd", F.lit(0))
    near = F.when(F.col("column_name").isNotNull(), F.abs(F.col("distinct_values_count") - nd) <= 0.08 * nd + 1)
    return both.select("column_name", "data_size", near.alias("distinct_ok"), "nulls_fraction", "row_count", "low_value",
                       "high_value", "schema_name", "table_name")


@query("history_trino_window")
def q_history_trino_window(spark, d):
    h = _t(spark, d)["events"].withColumnRenamed("ts", "created")
    return starburst.trino_history(h, None, EV_START, EV_END)


@query("history_text_date")
def q_history_text_date(spark, d):
    return starburst.query_history(roles.text_date_history(_t(spark, d)), EV_START, EV_END)


@query("concat_missing")
def q_concat_missing(spark, d):
    # Disjoint text / double columns: a missing integer column would be null,
    # and nullable integers reach pandas differently from the two engines
    # (float64 NaN against Int64 <NA>); the schema union is the same.
    t = _t(spark, d)
    return nst.concat_frames([t["customer"].select("c_name", "c_acctbal", "c_mktsegment"),
                              t["supplier"].select("s_name", "s_acctbal")])


@query("concat_conflicts")
def q_concat_conflicts(spark, d):
    """Frames whose columns differ in type: numbers and texts, structs and texts, struct
    fields, array elements, long and fractional numbers, dates and timestamps."""
    t, x = _t(spark, d), F.expr
    a = t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("amount"),
                             x("struct(c_name as name, c_mktsegment as kind)").alias("detail"),
                             x("struct(c_custkey as a, struct(c_acctbal as v, c_name as w) as b)").alias("info"), x("array(c_custkey, c_nationkey)").alias("xs"),
                             F.lit("2024-01-05").cast("date").alias("at"))
    b = t["supplier"].select(F.col("s_name").alias("id"), F.col("s_acctbal").alias("amount"), F.col("s_name").alias("detail"),
                             x("struct(s_name as a, struct(s_suppkey as v) as b)").alias("info"), x("array(s_name)").alias("xs"),
                             F.lit("2024-01-05 01:02:03").cast("timestamp_ntz").alias("at"))
    both = nst.concat_frames([a, b])
    return both.select("id", F.col("amount"), "detail", F.col("info.a").alias("info_a"), F.col("info.b.v").alias("info_v"), F.col("info.b.w").alias("info_w"),
                       F.array_join("xs", "|").alias("xs"), "at")


# --- Athena ----------------------------------------------------------------------

@query("exec_window")
def q_exec_window(spark, d):
    return range_or_skip(roles.executions(_t(spark, d)), "submission", EV_START, EV_END)


@query("take_until")
def q_take_until(spark, d):
    return take_until(roles.executions(_t(spark, d)), "pos", "submission", EV_START, EV_END)


@query("flatten_events")
def q_flatten_events(spark, d):
    return nst.flatten_struct(roles.nested_executions(_t(spark, d)))


@query("athena_query_logs_zoned")
def q_athena_query_logs_zoned(spark, d):
    return athena.query_logs(roles.zoned_executions(_t(spark, d)), EV_START, EV_END)


@query("athena_query_logs")
def q_athena_query_logs(spark, d):
    return athena.query_logs(roles.nested_executions(_t(spark, d)), EV_START, EV_END)


def _checked_form(df: DataFrame) -> DataFrame:
    """Outputs as compared with DuckDB: zone-less times, and dates as midnight
    timestamps (the two engines hand DATE values to pandas as different
    Python types; the value is the same)."""
    df = utc_naive(df)
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in dates}) if dates else df


def queries() -> dict[str, Query]:
    """name -> callable; every output in the checked form."""
    return {name: (lambda fn: lambda spark, d: _checked_form(fn(spark, d)))(fn) for name, fn in _QUERIES.items()}


# Queries whose result is approximate by design: rows-only check.
APPROXIMATE: set[str] = set()
