"""Hot keys are spread over tasks: a third (or more) of the rows on one key."""

import glob
import os

from pyspark.sql import functions as F

from whlens.operators.joins import spread_order
from whlens.operators.temporal import temporal_join
from whlens.plans import roles
from whlens.sinks.writers import write_hourly


def _events(spark, n=6000):
    # warehouse 0 holds half of all events, spread over 30 days
    return (spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("w"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") % 43200))
        .alias("et")))


def test_bucketed_temporal_join_spreads_hot_key(spark):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    prev_bc = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # observe the plain hash placement
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # shuffled joins on both forms
    try:
        ev = _events(spark)
        versions = spark.range(50).select(F.col("id").cast("int").alias("w"),
                                          F.lit("2023-01-01").cast("timestamp_ntz").alias("s"),
                                          F.lit(None).cast("timestamp_ntz").alias("e"))
        j = temporal_join(ev, versions, ["w"], "et", "s", "e", broadcast_max_bytes=0)
        hot = j.where(F.col("f.w") == 0).select(F.spark_partition_id().alias("p"))
        assert hot.count() == 3000
        assert hot.distinct().count() >= 3            # the hot key is spread over several tasks
        plain = ev.join(versions, "w").where(F.col("w") == 0).select(F.spark_partition_id().alias("p"))
        assert plain.distinct().count() == 1          # what a key-only shuffle would do
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev_bc)


def test_spread_order_splits_a_hot_value(spark):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # no coalescing of the tiny partitions
    try:
        df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("t"),
                                      F.col("id"))
        rows = spread_order(df, F.col("t")).withColumn("p", F.spark_partition_id()).collect()
        assert [r.t for r in rows] == sorted(r.t for r in rows)       # still ordered by t
        assert len({r.p for r in rows if r.t == 7}) > 1               # the hot value spans tasks
        plain = df.orderBy("t").withColumn("p", F.spark_partition_id()).collect()
        assert len({r.p for r in plain if r.t == 7}) == 1             # without the tie-breaker: one task
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_hot_hour_written_by_several_tasks(spark, tmp_out):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2"}
    prev = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(40000).select(
            F.col("id"), F.lit("x" * 20).alias("pad"),
            F.when(F.col("id") % 3 == 0, F.lit("2024-01-05 10:30:00"))
            .otherwise(F.lit("2024-01-06 00:00:00")).cast("timestamp_ntz").alias("start_time"))
        path = os.path.join(tmp_out, "h")
        assert write_hourly(df, path, "start_time") == 40000
        hot = glob.glob(os.path.join(path, "hour=20240106_00", "*.parquet"))
        assert len(hot) > 1
        assert spark.read.parquet(path).count() == 40000
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shuffled_text_join_splits_hot_handle(spark, monkeypatch):
    """Above the broadcast bound the lateral text join is a shuffled join; a
    handle holding a third of the stats rows is split by AQE's skew join."""
    import contextlib
    import io

    from whlens.operators import text as txt
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    prev = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        stats = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("sql_handle"),
            F.col("id").alias("n"))
        texts = spark.range(500).select(F.col("id").alias("sql_handle"),
                                        F.concat(F.lit("q"), F.col("id").cast("string")).alias("text"))
        j = txt.apply_text(stats, texts)
        assert len(j.collect()) == 60000
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        assert "isFinalPlan=true" in buf.getvalue() and "SortMergeJoin(skew=true)" in buf.getvalue()
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_ddl_chunks_are_cut_after_the_join(spark):
    docs = spark.createDataFrame([(i, f"{i}é" * 300, "s") for i in range(20)] + [(20, None, None), (None, "x" * 200, "s"), (21, "", "s")], "doc_id long, text string, source string")
    events = spark.range(0, 30, 2).selectExpr("id as event_id", "timestamp_ntz'2024-01-05 00:00:00' as ts")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chunks = roles.ddl_chunks({"documents": docs, "events": events})
        plan = chunks._jdf.queryExecution().executedPlan().toString()
        rows = chunks.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.index("Generate") < plan.index("Join")  # no row of the join holds its text once per chunk
    for d in docs.collect():
        mine = sorted((r for r in rows if r.xid == d.doc_id), key=lambda r: r.sequence)
        n = max(1, -(-len(d.text or "") // 200))
        assert [(r.sequence, r.text) for r in mine] == [(i, None if d.text is None else d.text[200 * i:200 * i + 200]) for i in range(n)]


def test_table_schema_broadcasts_no_tables_columns_or_partitions(spark):
    from whlens.operators.catalog import table_schema
    part = spark.createDataFrame([(i, f"p{i % 3}", f"b{i % 2}", i) for i in range(12)], "p_partkey long, p_name string, p_brand string, p_size long")
    t = {"part": part}
    sides = (roles.is_tables(t), roles.sys_columns(t), roles.ms_tables(t), roles.ms_partitions(t))
    for schemas, by_schema in ((roles.ms_schemas(t), True), (None, False)):
        out = table_schema(*sides, schemas, by_schema=by_schema)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and plan.count("BroadcastExchange") == (1 if by_schema else 0)
        assert out.count() == 4 * (6 * 1 + 6 * 2)
