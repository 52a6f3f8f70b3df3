"""Incremental hourly export: two arrivals of landed history, two runs;
every row exported exactly once, same rows as the batch export."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from whlens.plans import databricks as dbx, roles
from whlens.plans.registry import EV_END, EV_START
from whlens.sources.files import TableSet
from whlens.streaming.hourly import run_hourly_export


def test_incremental_hourly_export(spark, tmp_out):
    t = TableSet(spark, SF001)
    hist = roles.query_history(t)
    land = os.path.join(tmp_out, "landed")
    out = os.path.join(tmp_out, "hourly")
    # first arrival: the first half of the stream, by time
    mid = "2024-01-08 00:00:00"
    hist.where(F.col("start_time") < F.lit(mid).cast("timestamp_ntz")).write.parquet(os.path.join(land, "a"))
    kw = dict(ts="start_time")
    run_hourly_export(spark, os.path.join(land, "*"), hist.schema, out, **kw)
    first = spark.read.parquet(out).count()
    # second arrival, second run: only the new files are read
    hist.where(F.col("start_time") >= F.lit(mid).cast("timestamp_ntz")).write.parquet(os.path.join(land, "b"))
    run_hourly_export(spark, os.path.join(land, "*"), hist.schema, out, **kw)
    got = spark.read.parquet(out)
    total = hist.count()
    assert 0 < first < got.count() == total == got.select("statement_id").distinct().count()
    batch = dbx.hourly_history(hist, EV_START, EV_END).select("statement_id", "hour")
    assert batch.exceptAll(got.select("statement_id", "hour")).isEmpty()
    # a third run with nothing new changes nothing
    run_hourly_export(spark, os.path.join(land, "*"), hist.schema, out, **kw)
    assert spark.read.parquet(out).count() == total
    # another output is another stream: it gets every row
    other = os.path.join(tmp_out, "hourly2")
    run_hourly_export(spark, os.path.join(land, "*"), hist.schema, other, **kw)
    assert spark.read.parquet(other).count() == total


def test_days_of_one_file_that_windows_would_split(spark, tmp_out):
    """Both days of a landed file are exported, whichever day a run is for."""
    land, out = os.path.join(tmp_out, "landed"), os.path.join(tmp_out, "out")
    df = spark.sql("select id, timestamp_ntz'2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(id as int)) as start_time from range(2)")
    df.coalesce(1).write.parquet(land)
    for _ in range(2):
        run_hourly_export(spark, land, df.schema, out)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1]


def test_streams_need_the_shared_folder(monkeypatch):
    import pytest

    from whlens.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            @staticmethod
            def getConf():
                return Conf()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_incremental_rest_history(spark, tmp_out):
    import __spark_entry__ as E
    from whlens.streaming.hourly import run_rest_history_export
    t = TableSet(spark, SF001)
    rec = roles.rest_records(t)
    pages = (rec.groupBy((F.col("user_id") % 20).alias("pg"))
             .agg(F.collect_list(F.struct(*rec.columns)).alias("res")).drop("pg"))
    land, out = os.path.join(tmp_out, "pages"), os.path.join(tmp_out, "out")
    pages.where(F.col("res")[0]["user_id"] % 2 == 0).write.json(os.path.join(land, "a"))
    run_rest_history_export(spark, os.path.join(land, "*"), out)
    first = spark.read.parquet(out).count()
    pages.where(F.col("res")[0]["user_id"] % 2 == 1).write.json(os.path.join(land, "b"))
    run_rest_history_export(spark, os.path.join(land, "*"), out)
    got = spark.read.parquet(out)
    want = E.queries()["rest_history"](spark, SF001).select("query_id")
    assert 0 < first < got.count() == got.select("query_id").distinct().count()
    assert want.exceptAll(got.select("query_id")).isEmpty()


def test_incremental_execution_export(spark, tmp_out):
    from whlens.streaming.hourly import run_execution_export
    t = TableSet(spark, SF001)
    x = roles.nested_executions(t)
    batches = (x.groupBy((F.col("pos") % 50).alias("b"))
               .agg(F.collect_list(F.struct(*x.columns)).alias("QueryExecutions")))
    land, out = os.path.join(tmp_out, "exec"), os.path.join(tmp_out, "out")
    batches.where(F.col("b") < 25).drop("b").write.json(os.path.join(land, "a"))
    schema = spark.read.json(os.path.join(land, "a")).schema
    run_execution_export(spark, os.path.join(land, "*"), schema, out)
    batches.where(F.col("b") >= 25).drop("b").write.json(os.path.join(land, "b"))
    run_execution_export(spark, os.path.join(land, "*"), schema, out)
    assert spark.read.parquet(out).count() == x.where("Status.SubmissionDateTime is not null").count()
