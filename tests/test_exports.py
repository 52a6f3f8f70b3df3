"""Every warehouse's named exports, run end to end on landed role tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from whlens.plans import registry as R
from whlens.plans import roles
from whlens.plans.exports import SPECS, Params, run_exports
from whlens.sources.files import TableSet


def _land(spark, root, frames):
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(os.path.join(root, name))
    return TableSet(spark, root)


def _status(spark, engine, landed, out, params):
    return {r.export: r for r in run_exports(spark, engine, landed, out, params).collect()}


def test_all_37_exports_registered():
    assert len([s for s in SPECS if not s.name.endswith(".csv") and not s.name.startswith("sizes_")]) == 37


def test_databricks_exports(spark, tmp_out):
    t = TableSet(spark, SF001)
    e = t["events"]
    landed = _land(spark, os.path.join(tmp_out, "land"), {
        "billing.usage": roles.usage(t), "billing.list_prices": roles.list_prices(t),
        "compute.warehouses": roles.warehouses(t),
        "compute.warehouse_events": roles.warehouse_events(t),
        "query.history": roles.query_history(t).withColumn("params", F.struct("user_id", "value")),
        "information_schema.tables": e.select(F.col("event_id").alias("table_id"), F.col("ts").alias("created"),
                                              F.col("ts").alias("last_altered")),
        "information_schema.columns": roles.sys_columns(t), "information_schema.views": roles.sf_views(t),
    })
    out = os.path.join(tmp_out, "out")
    p = Params(start=R.USAGE_START, end=R.USAGE_END, today=R.TODAY, open_end=R.OPEN_END, export_metadata=True)
    st = _status(spark, "databricks", landed, out, p)
    assert st["usage"].rows == 15549
    assert st["warehouse_info"].rows == 110
    assert st["tables"].status == "written"
    assert st["query_history_output"].status == "disabled"
    ev = _status(spark, "databricks", landed, out, Params(start=R.EV_START, end=R.EV_END, open_end=R.OPEN_END))
    from whlens.plans import databricks as dbx
    want = dbx.warehouse_events(roles.warehouse_events(t), roles.warehouses(t), R.EV_START, R.EV_END,
                                open_end=R.OPEN_END)
    assert ev["event"].rows == want.count()
    assert ev["query_history"].rows == 1945
    hist = spark.read.parquet(os.path.join(out, "databricks-logs", "query_history"))
    assert hist.schema["params"].dataType.simpleString() == "string"   # nested -> JSON text
    tables = spark.read.parquet(os.path.join(out, "databricks-logs", "tables"))
    assert tables.schema["created"].dataType.simpleString() == "string"


def test_databricks_rest_fallback(spark, tmp_out):
    t = TableSet(spark, SF001)
    rec = roles.rest_records(t)
    pages = (rec.groupBy((F.col("user_id") % 10).alias("pg"))
             .agg(F.collect_list(F.struct(*rec.columns)).alias("res")).drop("pg"))
    pages_dir = os.path.join(tmp_out, "pages")
    pages.write.json(pages_dir)
    landed = TableSet(spark, os.path.join(tmp_out, "empty_land"))   # no system.query.history
    out = os.path.join(tmp_out, "out")
    st = _status(spark, "databricks", landed, out, Params(start=R.EV_START, end=R.EV_END, rest_pages=pages_dir))
    assert st["query_history"].status == "not_applicable"
    assert st["query_history_output"].rows == E.queries()["rest_history"](spark, SF001).count()
    assert st["usage"].status == "failed"                            # isolation: others still ran


def test_snowflake_exports(spark, tmp_out):
    t = TableSet(spark, SF001)
    e = t["events"]
    landed = _land(spark, os.path.join(tmp_out, "land"), {
        "TABLES": roles.sf_tables(t), "VIEWS": roles.sf_views(t), "COLUMNS": roles.sf_tables(t),
        "FUNCTIONS": roles.sf_tables(t).withColumnRenamed("table_catalog", "function_catalog"),
        "WAREHOUSES": roles.warehouses(t),
        "WAREHOUSE_METERING_HISTORY": e.withColumnRenamed("ts", "start_time"),
        "QUERY_HISTORY": e.withColumnRenamed("ts", "end_time"),
    })
    st = _status(spark, "snowflake", landed, os.path.join(tmp_out, "out"), Params(start=R.EV_START, end=R.EV_END))
    assert st["tables"].rows == 1429 and st["views"].rows == 375 and st["columns"].rows == 1268
    assert st["functions"].rows == 1268 and st["warehouse"].rows == 130
    assert st["warehouse_usage"].rows == 1945 and st["query_history_snowflake"].rows == 1945


def test_mssql_exports(spark, tmp_out):
    t = TableSet(spark, SF001)
    landed = _land(spark, os.path.join(tmp_out, "land"), {
        "information_schema.tables": roles.is_tables(t), "information_schema.columns": roles.sys_columns(t),
        "sys.tables": roles.ms_tables(t), "sys.partitions": roles.ms_partitions(t),
        "sys.schemas": roles.ms_schemas(t),
        "sys.dm_exec_query_stats": roles.query_stats(t), "sys.dm_exec_sql_text": roles.query_texts(t),
    })
    p = Params(start=R.STATS_START, end=R.STATS_END, minmax_tables={n: t[n] for n in R.PROFILE_TABLES})
    st = _status(spark, "mssql", landed, os.path.join(tmp_out, "out"), p)
    assert st["schema"].rows == 12000
    assert st["column_min_max"].rows == 37
    assert st["query_history_mssql"].rows == 2019


@pytest.mark.parametrize("engine", ["trino", "starburst"])
def test_trino_starburst_exports(spark, tmp_out, engine):
    t = TableSet(spark, SF001)
    history = roles.text_date_history(t) if engine == "starburst" else t["events"]
    landed = _land(spark, os.path.join(tmp_out, "land"), {
        "information_schema.columns": roles.info_columns(t), "query_history": history})
    p = Params(start=R.EV_START, end=R.EV_END, catalog=R.CATALOG, schema="tpch", column_stats=True,
               stats_tables={n: t[n] for n in ("region", "nation")})
    out = os.path.join(tmp_out, "out")
    st = _status(spark, engine, landed, out, p)
    assert st[f"schema_info_{R.CATALOG}"].rows == 2668
    assert st["stats_tpch"].rows == 2 + 1 + 3 + 1
    hist = "query_history_starburst" if engine == "starburst" else "query_history_trino"
    assert st[hist].rows == (1945 if engine == "starburst" else 10000)
    assert os.path.isdir(os.path.join(out, f"{engine}-logs", "stats_tpch"))


def test_athena_exports(spark, tmp_out):
    t = TableSet(spark, SF001)
    x = roles.nested_executions(t)
    batches = (x.groupBy((F.col("pos") % 50).alias("b"))
               .agg(F.collect_list(F.struct(*x.columns)).alias("QueryExecutions")).drop("b"))
    exec_dir = os.path.join(tmp_out, "exec")
    batches.write.json(exec_dir)
    landed = TableSet(spark, os.path.join(tmp_out, "land"))
    p = Params(start=R.EV_START, end=R.EV_END, executions_path=exec_dir, athena_csv=True)
    st = _status(spark, "athena", landed, os.path.join(tmp_out, "out"), p)
    assert st["athena_query_logs"].rows == 1598
    assert st["athena_query_logs.csv"].rows == 1598
    early = _status(spark, "athena", landed, os.path.join(tmp_out, "out2"),
                    Params(start=R.EV_START, end=R.EV_END, executions_path=exec_dir, listing_pos="pos"))
    assert early["athena_query_logs"].rows == 471


def test_params_from_env():
    p = Params.from_env({"QUERY_LOG_START": "2024-01-01", "QUERY_LOG_END": "2024-01-31",
                         "EXPORT_METADATA": "True", "COLUMN_STATS": "false", "TRINO_CATALOG": "hive"},
                        schema="s")
    assert (p.start, p.end, p.export_metadata, p.column_stats, p.catalog, p.schema) == \
        ("2024-01-01", "2024-01-31", True, False, "hive", "s")


def test_cli_runs_query_logs_only(spark, tmp_out, capsys):
    from whlens.__main__ import main
    t = TableSet(spark, SF001)
    e = t["events"]
    land = os.path.join(tmp_out, "land")
    _land(spark, land, {"QUERY_HISTORY": e.withColumnRenamed("ts", "end_time")})
    code = main(["snowflake", land, os.path.join(tmp_out, "out"), "--start", R.EV_START, "--end", R.EV_END,
                 "--kind", "query_logs"])
    printed = capsys.readouterr().out
    assert code == 0 and "query_history_snowflake" in printed and "1945" in printed
    assert "warehouse_usage" not in printed


@pytest.mark.parametrize("source", ["scan", "analyze"])
def test_stats_from_catalog_schema(spark, tmp_out, source):
    spark.sql("create database if not exists whl_stats")
    t = TableSet(spark, SF001)
    for n in ("region", "nation"):
        t[n].write.mode("overwrite").saveAsTable(f"whl_stats.{n}")
    st = _status(spark, "trino", TableSet(spark, os.path.join(tmp_out, "land")), os.path.join(tmp_out, "out"),
                 Params(schema="whl_stats", column_stats=True, stats_source=source))
    assert st["stats_whl_stats"].rows == 2 + 1 + 3 + 1
    back = spark.read.parquet(os.path.join(tmp_out, "out", "trino-logs", "stats_whl_stats"))
    rows = {(r.table_name, r.column_name): r for r in back.collect()}
    assert rows[("region", None)].row_count == 5.0 and rows[("nation", None)].row_count == 25.0


def test_trino_history_named_table(spark, tmp_out):
    spark.sql("create database if not exists whl_hist")
    TableSet(spark, SF001)["events"].write.mode("overwrite").saveAsTable("whl_hist.queries")
    st = _status(spark, "trino", TableSet(spark, os.path.join(tmp_out, "land")), os.path.join(tmp_out, "out"),
                 Params(history_table="whl_hist.queries", catalog="c"))
    assert st["query_history_trino"].rows == 10000


def test_decision_options_reach_exports(spark, tmp_out):
    t = TableSet(spark, SF001)
    landed = _land(spark, os.path.join(tmp_out, "land"), {
        "information_schema.tables": roles.is_tables(t), "information_schema.columns": roles.sys_columns(t),
        "sys.tables": roles.ms_tables(t), "sys.partitions": roles.ms_partitions(t),
        "sys.schemas": roles.ms_schemas(t)})
    st = _status(spark, "mssql", landed, os.path.join(tmp_out, "out"), Params(sum_partitions=True))
    assert st["schema"].rows == 8000                  # one row per column once partitions are summed


def test_cli_params(spark, tmp_out, capsys):
    from whlens.__main__ import main
    t = TableSet(spark, SF001)
    land = os.path.join(tmp_out, "land")
    _land(spark, land, {"information_schema.tables": roles.is_tables(t),
                        "information_schema.columns": roles.sys_columns(t), "sys.tables": roles.ms_tables(t),
                        "sys.partitions": roles.ms_partitions(t), "sys.schemas": roles.ms_schemas(t)})
    code = main(["mssql", land, os.path.join(tmp_out, "out"), "--kind", "metadata",
                 "--param", "sum_partitions=true"])
    assert code == 1 and "8000" in capsys.readouterr().out        # no catalog of columns landed: min/max failed


def test_cli_min_max_of_the_catalogs_tables(spark, tmp_out, capsys):
    """Tables and columns come from the catalog; values above 2**53 stay exact."""
    from whlens.__main__ import main
    land = os.path.join(tmp_out, "land")
    frame = spark.createDataFrame
    _land(spark, land, {
        "sys.tables": frame([(1, "a", 1), (2, "a", 2), (3, "b", 1)], "object_id int, name string, schema_id int"),
        "sys.schemas": frame([(1, "x"), (2, "y")], "schema_id int, name string"),
        "sys.columns": frame([(1, "n", 56), (1, "t", 231), (2, "n", 127), (3, "m", 106)], "object_id int, name string, user_type_id int"),
        "sys.types": frame([(56, "int"), (127, "bigint"), (106, "decimal"), (231, "nvarchar")], "user_type_id int, name string"),
        "x.a": frame([(1, "z"), (7, "y")], "n int, t string"), "y.a": frame([(9007199254740993,), (5,)], "n long"),
        "x.b": frame([("1.25",), (None,)], "m string").selectExpr("cast(m as decimal(10, 2)) as m")})
    main(["mssql", land, os.path.join(tmp_out, "out"), "--kind", "metadata"])
    got = {(r.TableName, r.ColumnName, str(r.MinValue), str(r.MaxValue)) for r in spark.read.parquet(os.path.join(tmp_out, "out", "mssql-logs", "column_min_max")).collect()}
    assert got == {("a", "n", "1.00", "7.00"), ("a", "n", "5.00", "9007199254740993.00"), ("b", "m", "1.25", "1.25")}


def test_sorted_export_with_a_map_inside_a_struct(spark, tmp_out):
    from whlens.operators.joins import spread_order
    df = spark.sql("select id, named_struct('m', map('k', id), 'n', id) as s, array(map('a', 1)) as l, map(1, 'x') as m from range(20)")
    assert [r.id for r in spread_order(df, F.col("id").desc()).collect()] == list(range(19, -1, -1))


def test_exports_run_side_by_side(spark, tmp_out, monkeypatch):
    """Four exports, two of which fail, are under way together; each has its own pool."""
    import threading

    from whlens.plans import exports as X
    together = threading.Barrier(4, timeout=60)
    pools = []

    def build(fail):
        def make(t, p):
            together.wait()     # none goes on before all have begun
            pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
            if fail:
                raise ValueError("no such table")
            return spark.range(5)
        return make
    specs = [X.ExportSpec("redshift", f"e{i}", build(i in (1, 2))) for i in range(4)]
    monkeypatch.setattr(X, "SPECS", specs)
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    status = run_exports(spark, "redshift", {}, tmp_out, Params()).collect()
    assert [(r.export, r.status, r.rows) for r in status] == [("e0", "written", 5), ("e1", "failed", None), ("e2", "failed", None), ("e3", "written", 5)]
    assert sorted(pools) == [f"redshift-{i}" for i in range(4)]
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before
    assert {r.error for r in status if r.status == "failed"} == {"no such table"}
