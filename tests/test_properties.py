"""Property checks with small random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from whlens.operators import stats
from whlens.operators.temporal import temporal_join, version_intervals
from whlens.operators.text import reassemble_text
from whlens.operators.windows import range_or_skip, take_until
from whlens.sources.jdbc import hour_slices

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 1)


@SETTINGS
@given(text=st.text(alphabet="ab \n", min_size=0, max_size=300), size=st.integers(1, 40),
       block=st.integers(1, 6))
def test_reassemble_inverts_split(spark, text, size, block):
    chunks = [(1, i, text[i * size:(i + 1) * size]) for i in range(max(1, (len(text) + size - 1) // size))]
    df = spark.createDataFrame(chunks, "k int, seq int, text string")
    out = reassemble_text(df, ["k"], "seq", "text", rtrim=False, block_size=block).collect()
    assert out[0].sqltext == text


@SETTINGS
@given(changes=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 400)), min_size=1, max_size=12),
       events=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 500)), min_size=1, max_size=25),
       closed=st.sampled_from(["left", "both"]), bucket=st.sampled_from([None, "day", "month"]))
def test_temporal_forms_agree(spark, changes, events, closed, bucket):
    ch = spark.createDataFrame([(w, BASE + dt.timedelta(hours=h)) for w, h in set(changes)],
                               "w int, t timestamp").withColumn("t", F.col("t").cast("timestamp_ntz"))
    iv = version_intervals(ch, ["w"], "t", "2030-01-01 00:00:00", out="nt", small=True)
    iv_b = version_intervals(ch, ["w"], "t", "2030-01-01 00:00:00", out="nt", small=False)
    assert sorted(map(tuple, iv.collect())) == sorted(map(tuple, iv_b.collect()))
    ev = spark.createDataFrame([(i, w, BASE + dt.timedelta(hours=h)) for i, (w, h) in enumerate(events)],
                               "id int, w int, et timestamp").withColumn("et", F.col("et").cast("timestamp_ntz"))

    def pairs(max_rows):
        j = temporal_join(ev, iv, ["w"], "et", "t", "nt", closed=closed, small=bool(max_rows),
                          bucket=bucket)
        return sorted((r.id, r.t) for r in j.select("f.id", "v.t").collect())
    brute = sorted((i, BASE + dt.timedelta(hours=ch_h))
                   for i, (w, h) in enumerate(events)
                   for (cw, ch_h) in set(changes) if cw == w
                   for nxt in [min([x for (xw, x) in set(changes) if xw == w and x > ch_h], default=None)]
                   if h >= ch_h and (h <= nxt if (closed == "both" and nxt is not None) else
                                     (nxt is None or h < nxt)))
    assert pairs(1000) == pairs(0) == brute
    if closed == "left":
        ids = [i for i, _ in pairs(1000)]
        assert len(ids) == len(set(ids))          # at most one version per event


@SETTINGS
@given(changes=st.lists(st.tuples(st.integers(0, 1), st.one_of(st.none(), st.integers(0, 300))), min_size=1, max_size=10))
def test_interval_forms_agree_on_nulls(spark, changes):
    """Null and equal change times: the plain and the bucketed form give the same rows."""
    ch = spark.createDataFrame([(w, None if h is None else BASE + dt.timedelta(hours=h)) for w, h in changes],
                               "w int, t timestamp").withColumn("t", F.col("t").cast("timestamp_ntz"))
    forms = [sorted(map(str, version_intervals(ch, ["w"], "t", "2030-01-01 00:00:00", out="nt", small=small, bucket="day").collect()))
             for small in (True, False)]
    assert forms[0] == forms[1]


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(-10**6, 10**6), st.floats(-1e6, 1e6, allow_nan=False)),
                     min_size=1, max_size=30))
def test_min_max_agrees_with_python(spark, vals):
    df = spark.createDataFrame(vals, "a long, b double")
    got = {r.ColumnName: (r.MinValue, r.MaxValue) for r in stats.column_min_max(df, "t").collect()}
    assert got["a"] == (min(v[0] for v in vals), max(v[0] for v in vals))
    assert got["b"] == (min(v[1] for v in vals), max(v[1] for v in vals))


@settings(derandomize=True)
@given(start=st.integers(0, 1000), hours=st.integers(0, 100))
def test_hour_slices_disjoint_cover(start, hours):
    s = BASE + dt.timedelta(minutes=start)
    e = s + dt.timedelta(hours=hours, minutes=start % 60)
    sl = hour_slices(s, e)
    assert all(a < b for a, b in sl)
    assert all(sl[i][1] == sl[i + 1][0] for i in range(len(sl) - 1))
    assert (not sl and s >= e) or (sl[0][0] == s and sl[-1][1] == e)


@SETTINGS
@given(hours=st.lists(st.integers(-100, 400), min_size=1, max_size=25, unique=True))
def test_take_until_equals_filter_on_sorted_listing(spark, hours):
    listing = sorted(hours, reverse=True)          # newest first
    rows = [(i, BASE + dt.timedelta(hours=h)) for i, h in enumerate(listing)]
    df = spark.createDataFrame(rows, "pos int, t timestamp").withColumn("t", F.col("t").cast("timestamp_ntz"))
    s, e = "2024-01-02", "2024-01-10"
    a = sorted(r.pos for r in take_until(df, "pos", "t", s, e).collect())
    b = sorted(r.pos for r in range_or_skip(df, "t", s, e).collect())
    assert a == b


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from([0.0, -0.0, 1.5, float("nan"), None]),
                               st.sampled_from(["a, b", "a", "b", None]),
                               st.lists(st.sampled_from(["a, b", "a", "b"]), max_size=2)),
                     min_size=0, max_size=20))
def test_exact_distinct_counts_match_count_distinct(spark, rows):
    df = spark.createDataFrame(rows, "x double, s string, arr array<string>")
    got = {r["_i"]: r["_nd"] for r in stats.exact_distinct_counts(df).collect()}
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first()
    assert [got.get(i, 0) for i in range(3)] == [want["x"], want["s"], want["arr"]]
