"""Test-table roles: the driver's TPC-H-like tables shaped into the system
tables the exports read (see FIXTURES.md section 2).

Each role is a DataFrame derived from the given tables, so every query's
work grows with them. Generated rows ("numbers tables") are made with
``explode(sequence(...))`` rather than non-equi joins, texts are chunked
whole, and no role is cut to an id range.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from whlens.plans.redshift import (QUERY_METRICS_COLUMNS, QUERY_QUEUE_INFO_COLUMNS,  # noqa: F401
                                   QUERY_WLM_COLUMNS)

Tables = Mapping[str, DataFrame]


def ts(text: str) -> Column:
    """A ``timestamp_ntz`` literal (landed Parquet times are zone-less)."""
    return F.lit(text).cast("timestamp_ntz")


def c(name: str) -> Column:
    return F.col(name)


# --- Databricks ----------------------------------------------------------------

def warehouses(t: Tables) -> DataFrame:
    """Warehouse versions; every 10th renamed (fan-out in J1), every 5th with
    a second version under the same name (W2 keeps one)."""
    s = t["supplier"]

    def version(df, name, when):
        return df.select((c("s_suppkey") % 3).alias("account_id"), (c("s_suppkey") % 4).alias("workspace_id"),
                         c("s_suppkey").alias("warehouse_id"), name.alias("warehouse_name"),
                         ts(when).alias("change_time"))
    return (version(s, c("s_name"), "1995-01-01 00:00:00")
            .unionByName(version(s.where(c("s_suppkey") % 10 == 0), F.concat(c("s_name"), F.lit("_v2")),
                                 "1998-01-01 00:00:00"))
            .unionByName(version(s.where(c("s_suppkey") % 5 == 0), c("s_name"), "1997-01-01 00:00:00")))


def usage(t: Tables, nested: bool = True) -> DataFrame:
    """Billing usage: one row per line item, sku from the order priority."""
    l, o = t["lineitem"], t["orders"]
    u = l.join(o, c("l_orderkey") == c("o_orderkey")).select(
        (c("l_suppkey") % 3).alias("account_id"), (c("l_suppkey") % 4).alias("workspace_id"),
        c("l_suppkey").alias("warehouse_id"), c("o_orderpriority").alias("sku_name"),
        F.lit("DBU").alias("usage_unit"), c("l_quantity").alias("usage_quantity"),
        F.to_date(c("l_shipdate")).alias("usage_date"), c("l_shipdate").alias("usage_start_time"),
        c("l_shipdate").alias("usage_end_time"),
        F.when(c("l_returnflag") == "R", F.lit("JOBS")).otherwise(F.lit("SQL")).alias("billing_origin_product"))
    if nested:
        u = u.withColumn("usage_metadata", F.struct(c("warehouse_id").alias("warehouse_id")))
    return u


def list_prices(t: Tables, nested: bool = True) -> DataFrame:
    """Quarterly list prices per sku: open last version, one EUR sku, one sku
    without prices (5-LOW), one price that matches nothing (9-UNUSED)."""
    o = t["orders"].where(c("o_orderpriority") != "5-LOW")
    p = (o.groupBy(c("o_orderpriority").alias("sku_name"),
                   F.date_trunc("quarter", c("o_orderdate")).cast("timestamp_ntz").alias("price_start_time"))
         .agg(F.round(F.avg("o_totalprice") / 1000, 4).alias("price")))
    w = Window.partitionBy("sku_name").orderBy("price_start_time")
    p = p.select("sku_name", F.lit("DBU").alias("usage_unit"),
                 F.when(c("sku_name") == "4-NOT SPECIFIED", F.lit("EUR")).otherwise(F.lit("USD"))
                 .alias("currency_code"),
                 "price_start_time", F.lead("price_start_time").over(w).alias("price_end_time"), "price")
    unused = t["region"].where(c("r_regionkey") == 0).select(
        F.lit("9-UNUSED").alias("sku_name"), F.lit("DBU").alias("usage_unit"), F.lit("USD").alias("currency_code"),
        ts("1996-01-01 00:00:00").alias("price_start_time"),
        F.lit(None).cast("timestamp_ntz").alias("price_end_time"), F.lit(1.0).alias("price"))
    p = p.unionByName(unused)
    if nested:
        p = p.withColumn("pricing", F.struct(F.struct(c("price").alias("default")).alias("effective_list")))
    return p


def warehouse_changes(t: Tables) -> DataFrame:
    """Every event is a change of its warehouse."""
    return t["events"].select(c("user_id").alias("warehouse_id"), c("ts").alias("change_time"))


def warehouse_events(t: Tables) -> DataFrame:
    return t["events"].select(c("user_id").alias("warehouse_id"), c("ts").alias("event_time"),
                              "event_id", "event_type", "value")


def query_history(t: Tables) -> DataFrame:
    """``system.query.history``-like rows: the events stream."""
    return t["events"].select(c("event_id").alias("statement_id"), c("ts").alias("start_time"),
                              c("user_id"), c("event_type").alias("statement_type"), "value", "props")


def rest_metric_rule(name: str, i: int, kind: str) -> str:
    """SQL (same text in Spark and DuckDB) deriving REST metric ``name`` of
    an event: a boolean flag or a number from the event id."""
    if kind == "boolean":
        return "event_id % 7 = 0"
    return f"(event_id * {i + 3}) % 100003"


def rest_records(t: Tables) -> DataFrame:
    """REST history records (nested ``metrics``, every field set) from events,
    with the query text of the document of the same id (null when none)."""
    from whlens.sources.json_pages import HISTORY_METRICS
    e, d = t["events"], t["documents"]
    j = e.join(d, e["event_id"] == d["doc_id"], "left")
    start_ms = F.unix_millis(c("ts").cast("timestamp"))
    metrics = F.struct(*[F.expr(rest_metric_rule(n, i, ty.simpleString())).alias(n)
                         for i, (n, ty) in enumerate(HISTORY_METRICS)])
    return j.select(
        c("event_id").cast("string").alias("query_id"), c("text").alias("query_text"),
        c("user_id"), F.concat(F.lit("user"), c("user_id").cast("string")).alias("user_name"),
        start_ms.alias("query_start_time_ms"),
        (start_ms + (c("value") * 1000).cast("long")).alias("execution_end_time_ms"),
        F.when(c("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("FINISHED")).alias("status"),
        metrics.alias("metrics"))


#: Events of a landed page, and of every five pages: three on a line each, one printed
#: over many lines, one cut off if pages are to be broken.
PAGE_ROWS = 100


def land_history_pages(t: Tables, path: str, cut: bool = False) -> None:
    """Write the REST history as JSON responses under ``path``, as a client lands them:
    files of a response on each line, and files of one printed response."""
    records = rest_records(t)
    page = F.floor(c("query_id").cast("long") / PAGE_ROWS)
    pages = records.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*records.columns)).alias("res"))
    body = F.struct("res", F.lit(False).alias("has_more"))
    text = F.when(c("page") % 5 == 3, F.to_json(body, {"pretty": "true"})).otherwise(F.to_json(body))
    own_file = (c("page") % 5 == 3) | ((c("page") % 5 == 4) & F.lit(cut))
    whole = F.when((c("page") % 5 == 4) & F.lit(cut), F.expr("left(text, cast(length(text) * 2 / 3 as int))")).otherwise(c("text"))
    pages = pages.select("page", text.alias("text"), own_file.alias("own")).select("page", whole.alias("text"), "own")
    pages.where(~c("own")).select("text").write.text(f"{path}/lines")
    # Each in a file of its own, all in one folder, moved there by the tasks.
    (pages.where("own").select("text").write.option("maxRecordsPerFile", 1)
     .option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(f"{path}/documents"))


# --- Redshift ------------------------------------------------------------------

def ddl_chunks(t: Tables) -> DataFrame:
    """DDL text in 200-character chunks covering each whole document, with
    the statement time from the event of the same id and a padded label."""
    d, e = t["documents"], t["events"]
    n = F.greatest(F.ceil(F.length(c("text")) / 200), F.lit(1)).cast("long")
    # Documents are joined whole and then cut, so that no row holds more than its own chunk.
    j = (d.select("doc_id", "text", "source").join(e.select("event_id", "ts"), c("event_id") == c("doc_id"), "left"))
    chunks = F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                         lambda i: F.struct(i.alias("sequence"), F.substr(c("text"), i.cast("int") * 200 + 1, F.lit(200)).alias("text")))
    return j.select(c("doc_id").alias("xid"), (c("doc_id") % 11).alias("pid"), (c("doc_id") % 5).alias("userid"),
                    c("ts").alias("starttime"), c("ts").alias("endtime"),
                    F.concat(F.lit("  "), c("source"), F.lit(" ")).alias("label"), F.inline(chunks))


def stl_query(t: Tables) -> DataFrame:
    """Every conversation is a query, started on a day and second of its own."""
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(conv_id % 30 as int), 0, 0, min(length(text)))")
    return (t["conversations"].groupBy((c("conv_id") % 5).alias("userid"), (c("conv_id") * 2).alias("xid"),
                                       (c("conv_id") % 11).alias("pid"), c("conv_id").alias("query"))
            .agg(F.min(F.length("text").cast("long")).alias("aborted"),
                 F.min("turn").alias("concurrency_scaling_status"), start.alias("starttime"),
                 (start + F.expr("make_interval(0, 0, 0, 0, 0, cast(max(turn) as int), 0)")).alias("endtime")))


def stl_querytext(t: Tables) -> DataFrame:
    return t["conversations"].select((c("conv_id") % 5).alias("userid"), (c("conv_id") * 2).alias("xid"),
                                     (c("conv_id") % 11).alias("pid"), c("conv_id").alias("query"),
                                     c("turn").alias("sequence"), "text")


# Catalog names of built-in types, by oid.
BUILTIN_TYPES = {16: "bool", 18: "char", 20: "int8", 21: "int2", 23: "int4", 700: "float4", 701: "float8", 1042: "bpchar",
                 1043: "varchar", 1083: "time", 1114: "timestamp", 1184: "timestamptz", 1186: "interval",
                 1266: "timetz", 1560: "bit", 1562: "varbit", 1700: "numeric"}


def pg_type(t: Tables) -> DataFrame:
    p = t["part"]
    oid = c("p_partkey") + 1
    name = F.when(c("p_partkey") % 35 == 0, F.concat(F.lit("_"), c("p_name"))).when(
        c("p_partkey") % 4 == 1, F.replace(c("p_name"), F.lit(" "), F.lit("_"))).otherwise(c("p_name"))
    for builtin, typname in BUILTIN_TYPES.items():
        name = F.when(oid == builtin, F.lit(typname)).otherwise(name)
    return p.select(oid.alias("oid"), name.alias("typname"),
                    (c("p_size") % 6).alias("typnamespace"),
                    F.when(c("p_partkey") % 3 == 0, c("p_partkey") + 1).otherwise(F.lit(0)).alias("typrelid"),
                    F.when(c("p_partkey") % 5 == 0, c("p_partkey")).otherwise(F.lit(0)).alias("typelem"))


def pg_class(t: Tables) -> DataFrame:
    return t["part"].select((c("p_partkey") + 1).alias("oid"),
                            F.when(c("p_partkey") % 2 == 0, F.lit("c")).otherwise(F.lit("r")).alias("relkind"))


def pg_namespace(t: Tables) -> DataFrame:
    return t["region"].select(c("r_regionkey").alias("oid"), c("r_name").alias("nspname"))


def pg_cast(t: Tables) -> DataFrame:
    p = t["part"]
    return p.select((c("p_partkey") + 1).alias("castsource"), ((c("p_partkey") * 7) % 2500 + 1).alias("casttarget"),
                    F.when(c("p_partkey") % 4 == 0, F.lit(0)).otherwise(c("p_partkey")).alias("castfunc"),
                    F.when(c("p_partkey") % 3 == 0, F.lit("e")).when(c("p_partkey") % 3 == 1, F.lit("a"))
                    .otherwise(F.lit("i")).alias("castcontext"))


def pg_proc_args(t: Tables) -> DataFrame:
    """Long form of the argument vectors: ``p_partkey % 3`` arguments."""
    p = t["part"].where(c("p_partkey") % 3 > 0)
    x = p.select("p_partkey", F.explode(F.sequence(F.lit(0).cast("long"), c("p_partkey") % 3 - 1)).alias("pos"))
    return x.select((c("p_partkey") + 1).alias("oid"), c("pos").cast("int").alias("pos"),
                    ((c("p_partkey") * 3 + c("pos")) % 2000 + 1).alias("type_oid"))


def pg_proc(t: Tables, with_args: bool = True) -> DataFrame:
    p = t["part"].select((c("p_partkey") + 1).alias("oid"), c("p_name").alias("proname"),
                         c("p_size").alias("prorettype"), (c("p_partkey") % 3).alias("pronargs"),
                         (c("p_size") % 6).alias("pronamespace"), (c("p_partkey") % 2 == 0).alias("proisagg"))
    if not with_args:
        return p
    # oidvector: collect the long form to an ordered array per proc (<= 2 args)
    vec = (pg_proc_args(t).groupBy(c("oid").alias("_a_oid"))
           .agg(F.sort_array(F.collect_list(F.struct("pos", "type_oid"))).alias("_v"))
           .select("_a_oid", F.transform("_v", lambda x: x["type_oid"]).alias("proargtypes")))
    return p.join(vec, c("oid") == c("_a_oid"), "left").drop("_a_oid")


def pg_description(t: Tables) -> DataFrame:
    return t["part"].where(c("p_partkey") % 7 == 0).select(
        (c("p_partkey") + 1).alias("objoid"),
        F.when(c("p_partkey") % 2 == 0, F.lit("pg_type")).otherwise(F.lit("pg_proc")).alias("catalog_name"),
        c("p_type").alias("description"))


def search_path(t: Tables) -> DataFrame:
    return t["region"].where(c("r_regionkey") < 4).select(c("r_regionkey").alias("rank_on_path"),
                                                          c("r_name").alias("nspname"))


TIME_COLUMNS = {"starttime", "queue_start_time", "exec_start_time", "service_class_start_time",
                "queue_end_time", "exec_end_time", "service_class_end_time"}
TEXT_COLUMNS = {"service_class_name", "query_priority", "final_state", "database"}


def metric_column_rule(name: str, i: int) -> str:
    """How a metric-table role column is derived from ``orders``, as a SQL
    expression both Spark and DuckDB read: times from the order date, text
    from the priority, numbers from the order key."""
    if name in TIME_COLUMNS:
        return "o_orderdate"
    if name in TEXT_COLUMNS:
        return "o_orderpriority"
    return f"(o_orderkey * {i + 1}) % 1000"


def metric_table(t: Tables, columns) -> DataFrame:
    """A metric system table with ``columns`` plus one extra column the
    export must not carry."""
    cols = [F.expr(metric_column_rule(n, i)).alias(n) for i, n in enumerate(columns)]
    return t["orders"].select(*cols, c("o_totalprice").alias("extra_column"))


# --- Snowflake -----------------------------------------------------------------

def sf_tables(t: Tables) -> DataFrame:
    cu = t["customer"]
    return cu.select(
        F.when(c("c_nationkey") == 0, F.lit(None).cast("string")).when(c("c_nationkey") == 1, F.lit("SNOWFLAKE"))
        .otherwise(F.concat(F.lit("CAT_"), c("c_nationkey").cast("string"))).alias("table_catalog"),
        c("c_mktsegment").alias("table_schema"), c("c_name").alias("table_name"),
        F.when(c("c_custkey") % 11 == 0, ts("2024-01-01 00:00:00")).alias("deleted"))


def sf_views(t: Tables) -> DataFrame:
    cu = t["customer"]
    cat = F.concat(F.lit("CAT_"), c("c_nationkey").cast("string")).alias("table_catalog")
    live = cu.where(c("c_custkey") % 4 == 0).select(
        cat, c("c_mktsegment").alias("table_schema"), c("c_name").alias("table_name"),
        F.concat(F.lit("select "), c("c_custkey").cast("string")).alias("view_definition"),
        F.lit(None).cast("timestamp_ntz").alias("deleted"))
    old = cu.where(c("c_custkey") % 8 == 0).select(
        cat, c("c_mktsegment").alias("table_schema"), c("c_name").alias("table_name"),
        F.lit("old").alias("view_definition"), ts("2024-01-01 00:00:00").alias("deleted"))
    return live.unionByName(old)


# --- SQL Server ------------------------------------------------------------------

def table_name() -> Column:
    """Table names are unique within a schema, as in a real catalog (part
    names alone repeat, which would pair unrelated tables)."""
    return F.concat(c("p_name"), F.lit("_"), c("p_partkey").cast("string"))


def sys_tables(t: Tables) -> DataFrame:
    """Tables with partitions: index 0 (heap) for even ids, 1 and 2 for all;
    index 2 (non-clustered) must be filtered out."""
    p = t["part"]
    idx = F.when(c("p_partkey") % 2 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2)))
    return p.select(c("p_partkey").alias("object_id"), c("p_brand").alias("table_schema"),
                    table_name().alias("table_name"), F.explode(idx).alias("index_id"),
                    (c("p_size") * 10).alias("row_count"))


def sys_columns(t: Tables) -> DataFrame:
    """Four columns per table: int, varchar, decimal, tinyint."""
    p = t["part"]
    x = p.select("p_partkey", "p_brand", "p_name",
                 F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("n"))
    return x.select(c("p_partkey").alias("object_id"), c("p_brand").alias("table_schema"),
                    table_name().alias("table_name"), F.concat(F.lit("c"), c("n").cast("string")).alias("column_name"),
                    F.when(c("n") == 0, F.lit("int")).when(c("n") == 1, F.lit("varchar"))
                    .when(c("n") == 2, F.lit("decimal")).otherwise(F.lit("tinyint")).alias("data_type"))


def is_tables(t: Tables) -> DataFrame:
    return sys_tables(t).select("table_schema", "table_name").distinct()


def ms_tables(t: Tables) -> DataFrame:
    return sys_tables(t).select("object_id", c("table_name").alias("name"),
                                c("table_schema").alias("schema_id")).distinct()


def ms_partitions(t: Tables) -> DataFrame:
    return sys_tables(t).select("object_id", "index_id", c("row_count").alias("rows"))


def ms_schemas(t: Tables) -> DataFrame:
    return sys_tables(t).select(c("table_schema").alias("schema_id"), c("table_schema").alias("name")).distinct()


def ms_columns(t: Tables) -> DataFrame:
    return sys_columns(t).select("object_id", c("column_name").alias("name"), c("data_type").alias("user_type_id"))


def ms_types(t: Tables) -> DataFrame:
    return sys_columns(t).select(c("data_type").alias("user_type_id"), c("data_type").alias("name")).distinct()


def query_stats(t: Tables) -> DataFrame:
    return t["orders"].select(c("o_custkey").alias("sql_handle"), c("o_orderdate").alias("creation_time"),
                              "o_orderkey", "o_totalprice")


def query_texts(t: Tables) -> DataFrame:
    """Every 10th handle has no text (dropped by the lateral apply)."""
    return t["customer"].where(c("c_custkey") % 10 != 0).select(c("c_custkey").alias("sql_handle"),
                                                                 c("c_name").alias("text"))


# --- Trino / Starburst / Athena ----------------------------------------------------

def info_columns(t: Tables) -> DataFrame:
    """``information_schema.columns`` over three catalogs."""
    return sys_columns(t).select(
        F.concat(F.lit("CAT_"), (c("object_id") % 3).cast("string")).alias("table_catalog"),
        "table_schema", "table_name", "column_name",
        F.when(c("data_type") == "varchar", F.lit("YES")).otherwise(F.lit("NO")).alias("is_nullable"),
        "data_type")


def text_date_history(t: Tables) -> DataFrame:
    """Starburst-like history: a text ``date`` column and a map column."""
    e = t["events"]
    return e.select("event_id", F.date_format(c("ts"), "yyyy-MM-dd").alias("date"),
                    F.create_map(F.lit("event_type"), c("event_type")).alias("session_properties"),
                    c("ts").alias("create_time"), c("ts").alias("execution_start_time"),
                    c("ts").alias("end_time"), "value")


def executions(t: Tables) -> DataFrame:
    """Athena-like executions, newest first by ``pos``; one old record listed
    early (event 2500) and every 97th without a submission time."""
    e = t["events"]
    sub = (F.when(c("event_id") % 97 == 0, F.lit(None).cast("timestamp_ntz"))
           .when(c("event_id") == 2500, ts("2023-06-01 00:00:00")).otherwise(c("ts")))
    return e.select((F.lit(10000) - c("event_id")).alias("pos"), sub.alias("submission"),
                    c("event_type").alias("state"), "value")


def nested_executions(t: Tables) -> DataFrame:
    """Executions as nested records ``Status{SubmissionDateTime, State}``."""
    x = executions(t)
    return x.select("pos", F.struct(c("submission").alias("SubmissionDateTime"),
                                    c("state").alias("State")).alias("Status"), "value")


def zoned_executions(t: Tables) -> DataFrame:
    """The same executions with times as JSON text has them, in three zones."""
    x = nested_executions(t)
    sub = F.col("Status.SubmissionDateTime")

    def text(shift: str, zone: str):
        return F.concat(F.date_format(sub + F.expr(f"interval '{shift}' hour to minute"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone))
    zoned = (F.when(c("pos") % 3 == 0, text("00:00", "Z")).when(c("pos") % 3 == 1, text("02:00", "+02:00"))
             .otherwise(text("-05:30", "-05:30")))
    return x.select("pos", F.struct(zoned.alias("SubmissionDateTime"), F.col("Status.State").alias("State")).alias("Status"), "value")
