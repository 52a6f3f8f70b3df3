"""The sorted interval join against the plain form, and global order in one pass."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_plans import plan

from whlens.operators.intervals import sorted_interval_join
from whlens.operators.joins import quantile_order
from whlens.operators.temporal import temporal_join

FACTS, VERSIONS = "id int, k string, j int, at int", "vid int, k string, j bigint, start int, end int"
maybe = st.one_of(st.none(), st.integers(0, 12))


def both(spark, facts, versions, how, closed, partitions):
    f = spark.createDataFrame([(i, *x) for i, x in enumerate(facts)], FACTS)
    v = spark.createDataFrame([(i, *x) for i, x in enumerate(versions)], VERSIONS)
    on = [("k", "k"), ("j", "j")]
    plain = temporal_join(f, v, on, "at", "start", "end", how, closed, small=True)
    stream = sorted_interval_join(f, v, on, "at", "start", "end", how, closed, partitions=partitions)
    rows = lambda df: sorted(((r.id, r.vid) for r in df.select("f.id", "v.vid").collect()), key=str)
    return rows(stream), rows(plain)


@settings(max_examples=20, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(facts=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2]), maybe), max_size=25),
       versions=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2]), maybe, maybe), max_size=15),
       how=st.sampled_from(["inner", "facts_left"]), closed=st.sampled_from(["left", "both"]), partitions=st.integers(1, 9))
def test_as_the_plain_form(spark, facts, versions, how, closed, partitions):
    """Overlaps, equal boundaries, null keys, times and ends, rows that repeat."""
    stream, plain = both(spark, facts, versions, how, closed, partitions)
    assert stream == plain


def test_no_explosion_and_whole_rows(spark):
    f = spark.range(2000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("k"),
                                 F.expr("timestamp_ntz'2000-01-01 00:00:00' + make_interval(0, 0, 0, cast(id * 5 as int))").alias("at"),
                                 F.expr("named_struct('a', id, 'b', array(id))").alias("nested"))
    v = spark.range(3).select(F.col("id").alias("vid"), F.col("id").cast("string").alias("k"), F.lit("1990-01-01").cast("date").alias("start"),
                              F.lit(None).cast("date").alias("end"), F.expr("map('m', id)").alias("m"))
    out = temporal_join(f, v, ["k"], "at", "start", "end", small=False)
    assert "Generate" not in plan(out)
    got = out.select("f.*", "v.vid", "v.m").collect()
    assert sorted(r.id for r in got) == list(range(2000))
    assert all(int(r.k) == r.vid and r.nested.b == [r.id] and r.m == {"m": r.vid} for r in got)
    # versions that are open for 27 years reach the partitions of their key, not its days
    from whlens.operators import intervals as I
    cuts = [(f'{{"k0":"{i}"}}', t, 0) for i in range(3) for t in (10, 20)]
    batch = v.select(F.concat(F.lit('{"k0":"'), "k", F.lit('"}')).alias("k"), F.lit(0).cast("long").alias("t"), F.lit(None).cast("long").alias("e")).toArrow().to_batches()
    rows = sum(b.num_rows for b in I._spread(iter(batch), cuts))
    assert rows == 9


def test_hot_key_and_instant_are_split(spark):
    """Nine tenths of the facts share one key, half of them one time too."""
    f = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(0).alias("k"),
                                   F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id") % 1000).cast("int").alias("at"))
    v = spark.range(70).select((F.col("id") % 7).alias("k"), (F.floor(F.col("id") / 7) * 100).cast("int").alias("start"), ((F.floor(F.col("id") / 7) + 1) * 100).cast("int").alias("end"))
    out = sorted_interval_join(f, v, [("k", "k")], "at", "start", "end", partitions=16)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) >= 14 and max(sizes) < 4 * 20_000 / 16
    plain = temporal_join(f, v, ["k"], "at", "start", "end", small=True)
    assert out.select("f.id", "v.start").exceptAll(plain.select("f.id", "v.start")).isEmpty()


def test_times_of_other_types_are_refused(spark):
    f, v = spark.sql("select 1 k, 'x' at"), spark.sql("select 1 k, 1 start, 2 end")
    with pytest.raises(TypeError):
        sorted_interval_join(f, v, [("k", "k")], "at", "start", "end")


@pytest.mark.parametrize("descending", [False, True])
def test_one_pass_order(spark, descending):
    seen = spark.sparkContext.accumulator(0)
    base = dt.datetime(2024, 1, 1)

    def rows(part):
        for i in part:
            seen.add(1)
            yield (i, None if i % 50 == 0 else base + dt.timedelta(hours=100 if i % 3 == 0 else i % 997))
    df = spark.createDataFrame(spark.sparkContext.range(6000, numSlices=4).mapPartitions(rows), "id long, t timestamp_ntz")
    narrow = spark.range(6000).select(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(if(id % 3 = 0, 100, id % 997) as int))").alias("t"))
    out = quantile_order(df, "t", narrow, descending, partitions=8)
    assert seen.value == 0      # building the plan runs nothing
    got = [r.t for r in out.collect()]
    assert seen.value == 6000   # and the rows are made once
    want = sorted((t for t in got if t), reverse=descending)
    nulls = [None] * 120
    assert got == (want + nulls if descending else nulls + want)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2.5 * 6000 / 8      # the hot hour is split


def test_order_of_few_rows(spark):
    empty = spark.createDataFrame([], "t int")
    assert quantile_order(empty, "t", empty).collect() == []
    three = spark.createDataFrame([(3,), (None,), (1,)], "t int")
    for narrow in (three, empty):
        assert [r.t for r in quantile_order(three, "t", narrow, partitions=5).collect()] == [None, 1, 3]
    assert [r.t for r in quantile_order(three, "t", three, True, partitions=1).collect()] == [3, 1, None]
