"""Edge rows (FIXTURES section 3) on tiny in-line frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.functions.normalize import iso_text, round_half_even_ms, utc_naive
from whlens.operators import nested as nst
from whlens.operators import stats as st
from whlens.operators.filters import exclude_text, live_rows, visible_objects
from whlens.operators.temporal import latest_per_key, temporal_join, version_intervals
from whlens.operators.text import reassemble_text
from whlens.operators.windows import in_window, range_or_skip, take_until


def D(s):
    return dt.datetime.fromisoformat(s)


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# --- J4 temporal join ---------------------------------------------------------------

@pytest.fixture()
def prices(spark):
    rows = [("a", D("2024-01-01 00:00:00"), D("2024-02-01 00:00:00"), 2.0),
            ("a", D("2024-02-01 00:00:00"), None, 3.0),
            ("b", D("2024-01-01 00:00:00"), None, None)]
    return ntz(spark.createDataFrame(rows, "sku string, ps timestamp, pe timestamp, price double"), "ps", "pe")


@pytest.fixture()
def usage(spark):
    rows = [(1, "a", D("2024-01-01 00:00:00")),   # exactly at start: first version
            (2, "a", D("2024-02-01 00:00:00")),   # exactly at end: next version only
            (3, "a", D("2023-12-31 23:59:59")),   # before the first price: lost
            (4, "a", D("2030-06-01 00:00:00")),   # open-ended last price
            (5, "b", D("2024-03-01 00:00:00"))]   # price without amount
    return ntz(spark.createDataFrame(rows, "id int, sku string, t timestamp"), "t")


@pytest.mark.parametrize("max_rows", [1000, 0])   # broadcast form / day-bucket form
def test_temporal_join_half_open(usage, prices, max_rows):
    j = temporal_join(usage, prices, ["sku"], "t", "ps", "pe", closed="left", small=bool(max_rows))
    got = {r.id: r.price for r in j.select("f.id", "v.price").collect()}
    assert got == {1: 2.0, 2: 3.0, 4: 3.0, 5: None}
    cost = j.select("f.id", F.coalesce(F.lit(10.0) * F.col("v.price"), F.lit(0.0)).alias("c"))
    assert {r.id: r.c for r in cost.collect()}[5] == 0.0


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_temporal_join_facts_left(usage, prices, max_rows):
    j = temporal_join(usage, prices, ["sku"], "t", "ps", "pe", how="facts_left", small=bool(max_rows))
    got = sorted((r.id, r.price) for r in j.select("f.id", "v.price").collect())
    assert [i for i, _ in got] == [1, 2, 3, 4, 5]
    assert dict(got)[3] is None


# --- J5 / W1 version intervals ---------------------------------------------------------

@pytest.mark.parametrize("max_rows", [1000, 0])
def test_version_interval_boundaries(spark, max_rows):
    ch = ntz(spark.createDataFrame([(1, D("2024-01-01 00:00:00")), (1, D("2024-01-05 00:00:00")),
                                    (2, D("2024-01-03 00:00:00"))], "w int, t timestamp"), "t")
    iv = version_intervals(ch, ["w"], "t", "2030-01-01 00:00:00", out="nt")
    ev = ntz(spark.createDataFrame([(10, 1, D("2024-01-05 00:00:00")),   # mid change: two rows
                                    (11, 1, D("2024-01-01 00:00:00")),   # first change: one row
                                    (12, 1, D("2023-12-31 00:00:00")),   # before first: lost
                                    (13, 2, D("2025-01-01 00:00:00"))],  # single version, open end
                                   "id int, w int, et timestamp"), "et")
    j = temporal_join(ev, iv, ["w"], "et", "t", "nt", closed="both", small=bool(max_rows))
    ids = sorted(r.id for r in j.select("f.id").collect())
    assert ids == [10, 10, 11, 13]
    once = temporal_join(ev, iv, ["w"], "et", "t", "nt", closed="left", small=bool(max_rows))
    assert sorted(r.id for r in once.select("f.id").collect()) == [10, 11, 13]


# --- W2 latest per key ------------------------------------------------------------------

def test_latest_per_key(spark):
    df = spark.createDataFrame([("x", 1, None), ("y", 1, 5), ("y", 2, None), ("z", 3, 7), ("z", 4, 7)],
                               "k string, tb int, t int")
    got = {r.k: r.tb for r in latest_per_key(df, ["k"], "t", ["tb"]).collect()}
    assert got == {"x": 1, "y": 1, "z": 3}


# --- A3 ordered reassembly ----------------------------------------------------------------

@pytest.mark.parametrize("block", [4096, 2])
def test_reassemble_text(spark, block):
    rows = [(1, 0, "create "), (1, 1, "   "), (1, 2, None), (1, 3, "table t\n"), (1, 4, "x  "),
            (2, 0, "single")]
    df = spark.createDataFrame(rows, "k int, seq int, text string")
    got = {r.k: r.sqltext for r in reassemble_text(df, ["k"], "seq", "text", block_size=block).collect()}
    assert got == {1: "create   table t\nx", 2: "single"}
    raw = {r.k: r.sqltext for r in reassemble_text(df, ["k"], "seq", "text", rtrim=False,
                                                    block_size=block).collect()}
    assert raw[1] == "create    table t\nx  "


def test_reassemble_round_trip(spark):
    text = "".join(chr(97 + (i * 7) % 26) + (" " if i % 5 == 0 else "") for i in range(3000))
    chunks = [(7, i, text[i * 200:(i + 1) * 200]) for i in range((len(text) + 199) // 200)]
    df = spark.createDataFrame(chunks, "k int, seq int, text string")
    for block in (3, 4096):
        out = reassemble_text(df, ["k"], "seq", "text", rtrim=False, block_size=block).collect()
        assert out[0].sqltext == text


# --- F10 / F12 / F16 filters -----------------------------------------------------------------

def test_not_in_drops_null_catalog(spark):
    df = spark.createDataFrame([(None, None), ("SNOWFLAKE", None), ("DB", None)], "table_catalog string, deleted string")
    assert [r.table_catalog for r in live_rows(df).collect()] == ["DB"]


def test_exclude_text(spark):
    df = spark.createDataFrame([(1, None), (2, "a license"), (3, "a License"), (4, "100%_x"), (5, "100ab")],
                               "id int, text string")
    assert sorted(r.id for r in exclude_text(df, "text", ["License"]).collect()) == [1, 2, 4, 5]
    assert sorted(r.id for r in exclude_text(df, "text", ["%_"]).collect()) == [1, 2, 3, 5]


def test_visibility(spark):
    objs = spark.createDataFrame([(1, "t", "s2"), (2, "t", "s1"), (3, "u", "s9"), (4, "v", "s2")],
                                 "oid int, name string, nsp string")
    path = spark.createDataFrame([(0, "s1"), (1, "s2")], "rank_on_path int, nspname string")
    got = sorted(r.oid for r in visible_objects(objs, ["name"], "nsp", path).collect())
    assert got == [2, 4]


# --- F3 / F4 / F5 / F7 windows ------------------------------------------------------------------

@pytest.fixture()
def times(spark):
    vals = ["2024-01-05 00:00:00", "2024-01-04 23:59:59.999999", "2024-01-10 00:00:00",
            "2024-01-10 23:59:59", "2024-01-10 23:59:59.500000", "2024-01-11 00:00:00"]
    return ntz(spark.createDataFrame([(i, D(v)) for i, v in enumerate(vals)], "id int, t timestamp"), "t")


@pytest.mark.parametrize("mode,ids", [("half_open_days", [0, 2, 3, 4]), ("closed_instant", [0, 2]),
                                      ("closed_day_second", [0, 2, 3]), ("date_between", [0, 2, 3, 4])])
def test_window_modes(times, mode, ids):
    got = sorted(r.id for r in in_window(times, "t", "2024-01-05", "2024-01-10", mode).collect())
    assert got == ids


def test_epoch_ms_window(times):
    ms = times.select("id", F.unix_millis(F.col("t").cast("timestamp")).alias("ms"))
    got = sorted(r.id for r in in_window(ms, "ms", "2024-01-05", "2024-01-10", "epoch_ms_closed").collect())
    assert got == [0, 2, 3, 4]


# --- F14 / F15 -----------------------------------------------------------------------------

def _listing(spark, rows):
    return ntz(spark.createDataFrame(rows, "pos int, t timestamp"), "t")


def test_take_until(spark):
    s, e = "2024-01-05", "2024-01-10"
    sorted_rows = [(0, D("2024-01-09 00:00:00")), (1, D("2024-01-07 00:00:00")), (2, D("2024-01-04 00:00:00"))]
    df = _listing(spark, sorted_rows)
    assert sorted(r.pos for r in take_until(df, "pos", "t", s, e).collect()) == \
        sorted(r.pos for r in range_or_skip(df, "t", s, e).collect())
    early = _listing(spark, [(0, D("2024-01-09 00:00:00")), (1, D("2023-01-01 00:00:00")),
                             (2, D("2024-01-07 00:00:00")), (3, None)])
    assert [r.pos for r in take_until(early, "pos", "t", s, e).collect()] == [0]
    none_old = _listing(spark, [(0, D("2024-01-11 00:00:00")), (1, None), (2, D("2024-01-06 00:00:00"))])
    assert [r.pos for r in take_until(none_old, "pos", "t", s, e).collect()] == [2]
    first_old = _listing(spark, [(0, D("2023-01-01 00:00:00")), (1, D("2024-01-06 00:00:00"))])
    assert take_until(first_old, "pos", "t", s, e).count() == 0


# --- A4 / A5 profiles --------------------------------------------------------------------------

def test_min_max_types_and_empty(spark):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("b", T.LongType()),
                           T.StructField("t", T.ByteType()), T.StructField("d", T.DateType()),
                           T.StructField("n", T.IntegerType())])
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(1, big, 1, dt.date(2024, 1, 1), None), (5, 3, 2, None, None)], schema)
    out = {r.ColumnName: (r.MinValue, r.MaxValue) for r in st.column_min_max(df, "x").collect()}
    assert set(out) == {"i", "b", "n"}              # tinyint and date excluded
    assert out["b"] == (Decimal(3), Decimal(big))   # no float column: exact decimal
    assert out["n"] == (None, None)
    empty = st.column_min_max(df.limit(0), "x").collect()
    assert all(r.MinValue is None for r in empty) and len(empty) == 3


def test_column_stats_empty_and_nulls(spark):
    df = spark.createDataFrame([(None, "a"), (None, None)], "n int, s string")
    rows = {r.column_name: r for r in st.column_stats(df, "sc", "tb", exact=True).collect()}
    assert rows["n"].nulls_fraction == 1.0 and rows["n"].distinct_values_count == 0.0
    assert rows["s"].data_size == 1.0 and rows[None].row_count == 2.0
    empty = {r.column_name: r for r in st.column_stats(df.limit(0), exact=True).collect()}
    assert empty[None].row_count == 0.0 and empty["n"].nulls_fraction is None


# --- N1 / N2 / N5 normalisation -------------------------------------------------------------------

def test_round_half_even_ms(spark):
    vals = ["2024-01-01 00:00:00.000500", "2024-01-01 00:00:00.001500", "2024-01-01 00:00:00.002501",
            "1969-12-31 23:59:59.998500"]
    df = ntz(spark.createDataFrame([(i, D(v)) for i, v in enumerate(vals)], "i int, t timestamp"), "t")
    got = [r.r for r in df.orderBy("i").select(round_half_even_ms(F.col("t")).alias("r")).collect()]
    want = [D("2024-01-01 00:00:00"), D("2024-01-01 00:00:00.002"), D("2024-01-01 00:00:00.003"),
            D("1969-12-31 23:59:59.998")]
    assert got == want


def test_iso_text_and_utc(spark):
    df = spark.createDataFrame([(D("2024-01-01 10:00:00"),), (D("2024-01-01 10:00:00.25"),), (None,)],
                               "t timestamp")
    assert [r.x for r in df.select(iso_text(F.col("t")).alias("x")).collect()] == \
        ["2024-01-01T10:00:00", "2024-01-01T10:00:00.250000", ""]
    assert utc_naive(df).schema["t"].dataType == T.TimestampNTZType()


# --- N3 / P6 / P7 / U2 nested ------------------------------------------------------------------

def test_nested_to_json(spark):
    schema = "s struct<x:int,y:string>, a array<int>, m map<string,int>"
    df = spark.createDataFrame([(None, [], {"k": 1}), ((1, None), [1, 2], None)], schema)
    got = [tuple(r) for r in nst.nested_to_json(df).collect()]
    assert got[0] == (None, "[]", '{"k":1}')
    assert got[1] == ('{"x":1,"y":null}', "[1,2]", None)


def test_flatten_struct(spark):
    schema = "id int, a struct<b:struct<c:int,d:string>,e:array<int>>"
    df = spark.createDataFrame([(1, ((5, "z"), [1])), (2, None)], schema)
    flat = nst.flatten_struct(df)
    assert flat.columns == ["id", "a.b.c", "a.b.d", "a.e"]
    rows = flat.orderBy("id").collect()
    assert tuple(rows[0]) == (1, 5, "z", [1]) and tuple(rows[1]) == (2, None, None, None)


def test_concat_disjoint(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("q",)], "y string")
    out = nst.concat_frames([a, b])
    assert out.columns == ["x", "y"] and out.count() == 2


@pytest.mark.parametrize("bucket", ["week", "month", "year"])
def test_temporal_join_buckets(usage, prices, bucket):
    j = temporal_join(usage, prices, ["sku"], "t", "ps", "pe", closed="left", broadcast_max_bytes=0,
                      bucket=bucket)
    assert {r.id: r.price for r in j.select("f.id", "v.price").collect()} == {1: 2.0, 2: 3.0, 4: 3.0, 5: None}


def test_normalisation_refuses_non_utc_session(spark):
    from whlens.functions.normalize import round_ms
    df = spark.createDataFrame([(D("2024-01-01 10:00:00"),)], "t timestamp")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            utc_naive(df)
        with pytest.raises(ValueError):
            round_ms(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
