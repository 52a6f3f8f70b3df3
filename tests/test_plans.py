"""Plan shape for scale: pushdown, pruning, no quadratic joins, top-1 limits,
single-scan profiles. Checked on the physical plans of the registered queries."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from conftest import SF001
from whlens.plans.registry import queries as registered

QUERIES = {n: q for n, q in E.queries().items() if n in registered()}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_no_python_udf_anywhere(spark):
    for name, q in QUERIES.items():
        p = plan(q(spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_usage_cost_broadcasts_dimensions(spark):
    p = plan(QUERIES["usage_cost"](spark, SF001))
    assert p.count("BroadcastHashJoin") >= 2
    # the date window and the product filter reach the lineitem scan
    assert re.search(r"PushedFilters: \[[^\]]*l_shipdate", p) or "usage_date" in p


@pytest.mark.parametrize("name,column", [("warehouse_usage", "ts"), ("closed_window", "ts"),
                                         ("hourly_history", "ts"), ("history_by_end_time", "ts"),
                                         ("query_stats_text", "o_orderdate"), ("query_metrics", "o_orderdate")])
def test_window_pushed_to_scan(spark, name, column):
    p = plan(QUERIES[name](spark, SF001))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    assert any(column in f for f in pushed), pushed


def test_column_pruning(spark):
    p = plan(QUERIES["json_metrics"](spark, SF001))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas == ["struct<event_id:bigint,props:string>"]


@pytest.mark.parametrize("name", ["warehouse_info", "visible_objects", "usage_latest_name",
                                  "rs_types_visible"])
def test_top1_windows_use_group_limit(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    assert "WindowGroupLimit" in p


def test_min_max_single_scan(spark):
    p = plan(QUERIES["column_min_max"](spark, SF001))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1
    assert "stack(8" in p


def test_take_until_no_join(spark):
    p = plan(QUERIES["take_until"](spark, SF001))
    assert "Join" not in p.split("===== Subqueries =====")[0]
    assert "Subquery" in p


def test_table_schema_joins_by_schema(spark):
    df = QUERIES["table_schema"](spark, SF001)
    # one row per (column, heap/clustered partition) of the same-schema table
    assert df.count() == 12000


def test_building_a_plan_starts_no_job(spark):
    """Size decisions come from plan statistics."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    for name in ("query_text", "query_stats_text", "usage_cost", "usage_cost_bucketed", "warehouse_events_bucketed"):
        spark.read.parquet(f"{SF001}/region.parquet").schema   # file listings may run jobs; plans may not
        QUERIES[name](spark, SF001)
    jobs = set(tracker.getJobIdsForGroup(None)) - before
    stages = [tracker.getJobInfo(j) for j in jobs]
    assert all(s is None or len(s.stageIds) <= 1 for s in stages)


def test_statement_text_is_not_broadcast(spark):
    """Long texts get no hint: with automatic broadcasts off, the join is shuffled."""
    from whlens.operators import text as txt
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = spark.range(200).selectExpr("id as sql_handle", "repeat('select ', 2000) as text")
        stats = spark.range(1000).selectExpr("id % 200 as sql_handle", "id")
        joined = txt.apply_text(stats, texts)
        assert "BroadcastHashJoin" not in plan(joined) and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_aggregates_read_the_procs_once(spark):
    p = plan(QUERIES["rs_aggregates"](spark, SF001))
    assert p.count("proisagg") == 0 or p.count("ListAgg") + p.count("listagg") >= 1
