"""Sources and sinks: write -> read round trips, landed JSON, export runner."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from whlens.plans import athena, databricks as dbx, roles
from whlens.plans.exports import Params, run_exports
from whlens.plans.registry import EV_END, EV_START
from whlens.sinks.writers import export_path, hourly_ledger, write_csv, write_export, write_hourly
from whlens.sources.catalog import first_readable, list_tables, live_catalog_columns
from whlens.sources.files import TableSet
from whlens.sources.jdbc import hour_slices, slice_predicates
from whlens.sources.json_pages import read_executions, read_history_pages
from whlens.operators.stats import analyze_table


def test_write_export_round_trip(spark, tmp_out):
    df = spark.read.parquet(f"{SF001}/customer.parquet")
    path = os.path.join(tmp_out, "customer")
    assert write_export(df, path) == df.count()
    back = spark.read.parquet(path)
    assert back.columns == df.columns
    assert back.exceptAll(df).count() == 0


def test_write_export_normalises_times(spark, tmp_out):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0, 0, 1500))], "i int, t timestamp")
    path = os.path.join(tmp_out, "t")
    write_export(df, path)
    back = spark.read.parquet(path)
    assert back.first().t == dt.datetime(2024, 1, 1, 10, 0, 0, 2000)


def test_times_are_stored_in_milliseconds(spark, tmp_out):
    """Zoned and zone-less times alike, as UTC instants."""
    import pyarrow.parquet as pq
    df = spark.sql("select timestamp'2024-01-01 10:00:00.0015' as a, timestamp_ntz'2024-01-01 10:00:00.0025' as b")
    path = os.path.join(tmp_out, "ms")
    write_export(df, path)
    schema = pq.read_schema(glob.glob(f"{path}/part-*")[0])
    assert {str(schema.field(c).type) for c in "ab"} == {"timestamp[ms, tz=UTC]"}
    row = spark.read.parquet(path).selectExpr("cast(a as string) a", "cast(b as string) b").first()
    assert row.a == "2024-01-01 10:00:00.002" and row.b == "2024-01-01 10:00:00.002"


def test_an_export_that_turns_empty_leaves_nothing(spark, tmp_out):
    df = spark.read.parquet(f"{SF001}/region.parquet")
    for write, path in ((lambda d, p: write_export(d, p, on_empty="skip"), os.path.join(tmp_out, "a")), (write_csv, os.path.join(tmp_out, "b"))):
        assert write(df, path) == 5
        assert write(df.where("false"), path) is None and not os.path.exists(path)


def test_plain_write_runs_the_plan_once(spark, tmp_out):
    """Emptiness comes from the write's own row count."""
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r
    df = spark.createDataFrame(spark.range(10).rdd.mapPartitions(count), "id long")
    assert write_export(df, os.path.join(tmp_out, "once"), on_empty="skip") == 10 and seen.value == 10


def test_empty_policies(spark, tmp_out):
    df = spark.read.parquet(f"{SF001}/region.parquet").where("false")
    skipped = os.path.join(tmp_out, "skip")
    assert write_export(df, skipped, on_empty="skip") is None
    assert not os.path.exists(skipped)
    kept = os.path.join(tmp_out, "keep")
    assert write_export(df, kept, on_empty="schema") == 0
    back = spark.read.parquet(kept)
    assert back.columns == df.columns and back.count() == 0


def test_write_hourly(spark, tmp_out):
    t = TableSet(spark, SF001)
    h = dbx.hourly_history(roles.query_history(t), EV_START, EV_END)
    path = os.path.join(tmp_out, "query_history")
    rows = write_hourly(h, path, "start_time")
    assert rows == 1945
    hours = sorted(os.path.basename(p) for p in glob.glob(f"{path}/hour=*"))
    assert len(hours) == 144 and hours[0] == "hour=20240105_00"
    back = spark.read.parquet(path)
    assert back.count() == 1945
    assert back.schema["props"].dataType.simpleString() == "string"


def _hours(path):
    return {os.path.basename(p)[5:] for p in glob.glob(f"{path}/hour=*")}


def test_hours_of_other_runs_stay(spark, tmp_out):
    """Two windows, one rerun with fewer hours, one empty window under one path."""
    path = os.path.join(tmp_out, "query_history")
    h = roles.query_history(TableSet(spark, SF001))

    def export(day, rows=None):
        w = dbx.hourly_history(h if rows is None else rows, day, day)
        return write_hourly(w, path, "start_time", window=(day, day))

    def expected(*days):
        cond = F.date_format("start_time", "yyyy-MM-dd").isin(*days)
        return sorted(r.statement_id for r in h.where(cond).select("statement_id").collect())

    def there():
        return sorted(r.statement_id for r in spark.read.parquet(path).select("statement_id").collect())

    first = export("2024-01-05")
    second = export("2024-01-06")
    assert first and second and there() == expected("2024-01-05", "2024-01-06")
    assert export("2024-01-05") == first and there() == expected("2024-01-05", "2024-01-06")
    # the rerun no longer finds rows at three in the morning: only that hour goes
    gone = F.date_format("start_time", "yyyyMMdd_HH") == "20240105_03"
    fewer = export("2024-01-05", h.where(~gone))
    lost = h.where(gone).count()
    assert lost and fewer == first - lost and "20240105_03" not in _hours(path) and len(_hours(path)) == 47
    assert len(there()) == first + second - lost
    # a window without any row changes nothing else
    assert export("2030-01-01") is None and len(there()) == first + second - lost
    assert export("2024-01-05", h.where("false")) is None and there() == expected("2024-01-06")
    ledger = hourly_ledger(spark, path)
    assert ledger.select("run").distinct().count() == 6 and ledger.count() == 6 * 24
    last = ledger.groupBy("hour").agg(F.max_by(F.struct("rows", "action"), "started").alias("x")).select("hour", "x.*").collect()
    assert {r.hour for r in last if r.rows} == _hours(path) and sum(r.rows for r in last) == second
    assert {r.action for r in last if r.hour.startswith("20240105")} <= {"emptied", "none"}


def test_hourly_without_a_window_and_without_times(spark, tmp_out):
    path = os.path.join(tmp_out, "q")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10)), (2, dt.datetime(2024, 1, 1, 10, 59)), (3, None)], "i int, t timestamp_ntz")
    assert write_hourly(df, path, "t") == 3
    assert sorted((r.hour or "", r.rows) for r in hourly_ledger(spark, path).collect()) == [("", 1), ("20240101_10", 2)]
    assert write_hourly(df.where("i = 2"), path, "t") == 1
    assert sorted(r.i for r in spark.read.parquet(path).collect()) == [2, 3]


def test_hourly_export_twice(spark, tmp_out):
    land, out = os.path.join(tmp_out, "landed"), os.path.join(tmp_out, "out")
    landed = _land(spark, land, {"query.history": roles.query_history(TableSet(spark, SF001))})
    for day in ("2024-01-05", "2024-01-06", "2030-01-01"):
        status = run_exports(spark, "databricks", landed, out, Params(start=day, end=day), ["query_history"], ("query_logs",)).collect()
        assert [r.status for r in status] == ["empty" if day > "2029" else "written"]
    assert len(_hours(os.path.join(out, "databricks-logs", "query_history"))) == 48


def test_write_csv(spark, tmp_out):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0, 0)), (2, None)], "i int, t timestamp")
    path = os.path.join(tmp_out, "csv")
    assert write_csv(df, path) == 2
    lines = sorted(open(f).read() for f in glob.glob(f"{path}/*.csv"))
    text = "".join(lines)
    assert "i,t" in text and "2024-01-01T10:00:00" in text


def test_export_path():
    assert export_path("/o", "trino", "stats_{schema}", schema="s1") == "/o/trino-logs/stats_s1"


def _land(spark, tmp, frames):
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(os.path.join(tmp, name))
    return TableSet(spark, tmp)


def test_run_exports_isolation(spark, tmp_out):
    t = TableSet(spark, SF001)
    land = os.path.join(tmp_out, "landed")
    landed = _land(spark, land, {
        "pg_type": roles.pg_type(t), "pg_namespace": roles.pg_namespace(t), "pg_class": roles.pg_class(t),
        "pg_description": roles.pg_description(t), "pg_proc": roles.pg_proc(t), "pg_cast": roles.pg_cast(t),
        "stl_query": roles.stl_query(t), "stl_querytext": roles.stl_querytext(t),
        "stl_ddltext": roles.ddl_chunks(t),
        "stl_query_metrics": roles.metric_table(t, roles.QUERY_METRICS_COLUMNS),
        "svl_query_queue_info": roles.metric_table(t, roles.QUERY_QUEUE_INFO_COLUMNS),
        "stl_wlm_query": roles.metric_table(t, roles.QUERY_WLM_COLUMNS),
        "information_schema.columns": roles.sys_columns(t), "pg_views": roles.sf_views(t),
        "pg_table_def": roles.sys_tables(t), "search_path": roles.search_path(t),
    })  # pg_user deliberately missing
    out = os.path.join(tmp_out, "out")
    status = {r.export: r for r in run_exports(spark, "redshift", landed, out,
                                               Params(start="2024-01-05", end="2024-01-25")).collect()}
    assert status["user"].status == "failed"
    for name in ("types", "aggregates", "casts", "query_text", "query_ddl", "query_metrics", "columns"):
        assert status[name].status == "written", (name, status[name].error)
    assert status["types"].rows == 85 and status["aggregates"].rows == 471
    back = spark.read.parquet(os.path.join(out, "redshift-logs", "types"))
    assert back.count() == 85
    # without a readable search path nothing is exported as if all were visible
    path = os.path.join(land, "search_path")
    for broken in ("corrupt", "missing"):
        for f in glob.glob(f"{path}/part-*") + glob.glob(f"{path}/.part-*"):
            if broken == "corrupt" and not f.endswith(".crc"):
                with open(f, "wb") as out_file:
                    out_file.write(b"no parquet")
            else:
                os.remove(f)
        status = {r.export: r for r in run_exports(spark, "redshift", TableSet(spark, land), out,
                                                   Params(start="2024-01-05", end="2024-01-25"), ["types", "aggregates", "casts"]).collect()}
        assert {r.status for r in status.values()} == {"failed"}, broken


def test_unreadable_history_fails(spark, tmp_out):
    land, out = os.path.join(tmp_out, "landed"), os.path.join(tmp_out, "out")
    os.makedirs(os.path.join(land, "query.history"))
    with open(os.path.join(land, "query.history", "part-0.parquet"), "wb") as f:
        f.write(b"no parquet")
    status = {r.export: r for r in run_exports(spark, "databricks", TableSet(spark, land), out,
                                               Params(start="2024-01-05", end="2024-01-06"), ["query_history"]).collect()}
    assert status["query_history"].status == "failed" and status["query_history"].error


def test_json_history_pages(spark, tmp_out):
    t = TableSet(spark, SF001)
    rec = roles.rest_records(t)
    pages = (rec.groupBy((F.col("user_id") % 50).alias("page"))
             .agg(F.collect_list(F.struct(*rec.columns)).alias("res"))
             .select("res", F.lit(None).cast("string").alias("next_page_token"), F.lit(False).alias("has_more")))
    path = os.path.join(tmp_out, "pages")
    pages.write.json(path)
    got = dbx.rest_history(read_history_pages(spark, path), EV_START, EV_END)
    want = E.queries()["rest_history"](spark, SF001)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_history_record_missing_metrics(spark, tmp_out):
    path = os.path.join(tmp_out, "p1")
    os.makedirs(path)
    with open(os.path.join(path, "page.json"), "w") as f:
        f.write('{"res": [{"query_id": "a", "status": "FINISHED", "query_start_time_ms": 1704412800000, '
                '"extra_key": 5}], "has_more": false}\n')
    out = dbx.rest_history(read_history_pages(spark, path), "2024-01-05", "2024-01-05").collect()
    assert len(out) == 1 and out[0].total_time_ms is None and out[0].query_text is None


def test_executions_json(spark, tmp_out):
    t = TableSet(spark, SF001)
    x = roles.nested_executions(t)
    batches = (x.groupBy((F.col("pos") % 200).alias("b"))
               .agg(F.collect_list(F.struct(*x.columns)).alias("QueryExecutions")).drop("b"))
    path = os.path.join(tmp_out, "exec")
    batches.write.json(path)
    got = athena.query_logs(read_executions(spark, path), EV_START, EV_END)
    want = E.queries()["athena_query_logs"](spark, SF001)
    assert sorted(got.columns) == sorted(want.columns)
    assert got.count() == want.count() == 1598


def test_slice_predicates_cover_day():
    s = dt.datetime(2024, 1, 5)
    sl = hour_slices(s, s + dt.timedelta(days=1))
    assert len(sl) == 24 and sl[0][1] == sl[1][0]
    preds = slice_predicates("start_time", s, s + dt.timedelta(days=1))
    assert preds[0] == ("start_time >= TIMESTAMP '2024-01-05 00:00:00' AND "
                        "start_time < TIMESTAMP '2024-01-05 01:00:00'")


def test_first_readable_falls_back(spark, tmp_out):
    missing = lambda: spark.read.parquet(os.path.join(tmp_out, "nope"))
    ok = lambda: spark.read.parquet(f"{SF001}/region.parquet")
    assert first_readable([missing, ok]).count() == 5
    with pytest.raises(RuntimeError):
        first_readable([missing])


def test_live_catalog_and_analyze(spark):
    spark.sql("create database if not exists whl_db")
    spark.read.parquet(f"{SF001}/region.parquet").write.mode("overwrite").saveAsTable("whl_db.region_t")
    assert "region_t" in list_tables(spark, "whl_db")
    cols = live_catalog_columns(spark, databases=["whl_db"]).collect()
    assert {r.column_name for r in cols} == {"r_regionkey", "r_name"}
    stats = {r.column_name: r for r in analyze_table(spark, "whl_db.region_t").collect()}
    assert stats[None].row_count == 5.0
    assert stats["r_regionkey"].low_value == 0.0 and stats["r_regionkey"].high_value == 4.0
    assert stats["r_name"].distinct_values_count == 5.0
