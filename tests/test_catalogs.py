"""Frames with conflicting types, sizes from files, catalogs of many tables."""

import itertools
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.operators import batches, nested as nst, profiles as pr, stats as st
from whlens.operators.sizes import database_size, file_sizes, table_sizes
from whlens.plans.exports import Params, run_exports
from whlens.sources.files import TableSet

#: A value of each type, and its text in a frame that conflicts with it.
VALUES = {
    "int": ("7", "7"), "bigint": ("9007199254740993L", "9007199254740993"), "double": ("1.5D", "1.5"), "decimal(10,2)": ("cast(2.25 as decimal(10,2))", "2.25"),
    "decimal(38,30)": ("cast(1.5 as decimal(38,30))", "1.500000000000000000000000000000"), "string": ("'x9'", "x9"), "boolean": ("true", "true"),
    "date": ("date'2024-01-05'", "2024-01-05"), "timestamp_ntz": ("timestamp_ntz'2024-01-05 01:02:03'", "2024-01-05 01:02:03"),
    "binary": ("X'0FA0'", "0FA0"), "struct<a:int,b:string>": ("named_struct('a', 1, 'b', cast(null as string))", '{"a":1,"b":null}'),
    "array<int>": ("array(1, null)", "[1,null]"), "map<string,int>": ("map('k', 1)", '{"k":1}'),
}


@pytest.mark.parametrize("a,b", list(itertools.combinations(VALUES, 2)))
def test_two_types_in_a_column(spark, a, b):
    frames = [spark.sql(f"select {i} as n, {VALUES[t][0]} as v, cast(null as {t}) as gone") for i, t in enumerate((a, b))]
    out = nst.concat_frames(frames)
    assert out.columns == ["n", "v", "gone"]
    rows = {r.n: r for r in out.collect()}
    assert len(rows) == 2 and all(r.gone is None for r in rows.values())
    if isinstance(out.schema["v"].dataType, T.StringType):
        assert [rows[0].v, rows[1].v] == [VALUES[a][1], VALUES[b][1]]
    else:   # nothing lost: each value is what it was
        assert a in ("int", "bigint", "double", "decimal(10,2)", "decimal(38,30)", "date")
        for i, t in enumerate((a, b)):
            assert spark.createDataFrame([(rows[i].v,)], T.StructType([out.schema["v"]])).select(F.col("v") == F.expr(VALUES[t][0])).first()[0]


def test_nested_conflicts(spark):
    a = spark.sql("select named_struct('x', 1L, 'in', named_struct('y', 2, 'z', 'q')) s, array(named_struct('p', 1)) xs, map('k', 1) m")
    b = spark.sql("select named_struct('IN', named_struct('y', 'text'), 'w', 5D) S, array(named_struct('p', 'one', 'r', 2)) xs, map('k', array(1)) m")
    empty = spark.createDataFrame([], "s struct<x:double>")
    out = nst.concat_frames([a, b, empty])
    assert out.schema.simpleString() == "struct<s:struct<x:double,in:struct<y:string,z:string>,w:double>,xs:array<struct<p:string,r:int>>,m:map<string,string>>"
    one, two = out.select(F.to_json(F.struct("*")).alias("j")).collect()
    assert json.loads(one.j) == {"s": {"x": 1.0, "in": {"y": "2", "z": "q"}}, "xs": [{"p": "1"}], "m": {"k": "1"}}
    assert json.loads(two.j) == {"s": {"in": {"y": "text"}, "w": 5.0}, "xs": [{"p": "one", "r": 2}], "m": {"k": "[1]"}}


def test_common_type_of_many_frames_whatever_their_order(spark):
    frames = [spark.sql(f"select {v} as v") for v in ("1", "2L", "cast(1.5 as decimal(5,1))")]
    kinds = {nst.concat_frames(list(p)).schema["v"].dataType.simpleString() for p in itertools.permutations(frames)}
    assert kinds == {"decimal(20,1)"}


def _listing(path):
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                found[os.path.join(folder, n)] = os.path.getsize(os.path.join(folder, n))
    return found


def test_sizes_against_a_listing(spark, tmp_out):
    spark.range(1000).repartition(3).write.parquet(f"{tmp_out}/a b%")
    spark.range(50).withColumn("day", F.col("id") % 4).write.partitionBy("day").parquet(f"{tmp_out}/parts")
    spark.range(0).write.parquet(f"{tmp_out}/empty")
    tables = {n: spark.read.parquet(f"{tmp_out}/{n}") for n in ("a b%", "parts", "empty")}
    for batch in (64, 1):
        got = {r.table_name: r for r in table_sizes(spark, tables, batch).collect()}
        for name, rows in (("a b%", 1000), ("parts", 50), ("empty", 0)):
            listed = _listing(f"{tmp_out}/{name}")
            assert (got[name].files, got[name].bytes, got[name].row_count) == (len(listed), sum(listed.values()), rows)
    (whole,) = database_size(table_sizes(spark, tables), schema_name="s").collect()
    everything = _listing(tmp_out)
    assert (whole.tables, whole.files, whole.bytes, whole.row_count, whole.schema_name) == (3, len(everything), sum(everything.values()), 1050, "s")
    per_file = {r.file.rsplit("/", 1)[1]: r for r in file_sizes(tables["a b%"]).collect()}
    assert sum(r.row_count for r in per_file.values()) == 1000 and all(r.bytes == os.path.getsize(f"{tmp_out}/a b%/{n}") for n, r in per_file.items())


def test_rows_are_counted_without_reading_columns(spark, tmp_out):
    spark.range(10).withColumn("wide", F.repeat(F.lit("x"), 100)).write.parquet(f"{tmp_out}/t")
    plan = file_sizes(spark.read.parquet(f"{tmp_out}/t"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "ReadSchema: struct<wide" not in plan


def test_batches_keep_plans_small(spark, monkeypatch):
    built = []

    def frame(i):
        built.append(i)
        return spark.range(i, i + 1)
    out = batches.in_batches(spark, ((lambda i=i: frame(i)) for i in range(23)), "id long", 5)
    assert sorted(r.id for r in out.collect()) == list(range(23)) and built == list(range(23))
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert batches.in_batches(spark, [], "id long").collect() == []
    assert batches.in_batches(spark, [lambda: spark.range(2)], "id long", 5).count() == 2


def test_min_max_of_many_tables(spark, tmp_out):
    """Each table is scanned once, a batch at a time: four batches here."""
    spark.range(3).select("id", (F.col("id") * 1.5).alias("amount")).coalesce(1).write.parquet(f"{tmp_out}/one")
    one = spark.read.parquet(f"{tmp_out}/one")
    out = st.column_min_max_all([(f"t{i}", one) for i in range(200)])
    assert out.count() == 400
    assert {(r.ColumnName, r.MinValue, r.MaxValue) for r in out.collect()} == {("id", 0.0, 2.0), ("amount", 0.0, 3.0)}


def test_statistics_take_one_statement_a_table(spark, monkeypatch):
    spark.sql("create database if not exists whl_stats")
    for n in ("t1", "t2"):
        spark.sql("select id, cast(id as double) / 2 as half, if(id = 3, null, concat('n', id)) as name, id > 1 as flag from range(10)").write.mode("overwrite").saveAsTable(f"whl_stats.{n}")
    said = []
    plain = spark.sql
    monkeypatch.setattr(spark, "sql", lambda text, *a, **k: said.append(text) or plain(text, *a, **k))
    got = {(r.table_name, r.column_name): r for r in st.analyze_schema(spark, "whl_stats", ["t1", "t2"], batch=1).collect()}
    assert len(said) == 2 and all(s.startswith("ANALYZE") for s in said)
    assert len(got) == 10
    assert got["t2", None].row_count == 10
    assert (got["t1", "id"].distinct_values_count, got["t1", "id"].low_value, got["t1", "id"].high_value, got["t1", "id"].nulls_fraction) == (10, 0, 9, 0)
    assert (got["t1", "half"].low_value, got["t1", "half"].high_value) == (0, 4.5)
    name = got["t1", "name"]
    assert (name.nulls_fraction, name.distinct_values_count, name.data_size) == (0.1, 9, 18) and name.low_value is None


def test_sizes_export(spark, tmp_out):
    tables = {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("region", "nation")}
    params = Params(catalog="c", schema="s", table_sizes=True, stats_tables=tables)
    (status,) = run_exports(spark, "trino", TableSet(spark, tmp_out), tmp_out, params, ["sizes_{schema}"]).collect()
    assert (status.status, status.rows) == ("written", 3)
    got = {r.table_name: r for r in spark.read.parquet(f"{tmp_out}/trino-logs/sizes_s").collect()}
    assert got["region"].row_count == 5 and got[None].row_count == 30 and got[None].bytes == got["region"].bytes + got["nation"].bytes


def test_profiles_read_new_files_only(spark, tmp_out):
    """The profile of two days is the merge of two days' profiles; the old day is not read again."""
    path, store = f"{tmp_out}/landed", f"{tmp_out}/store"
    day = lambda a, b: spark.range(a, b).select("id", (F.col("id") % 100).alias("few"), F.concat(F.lit("n"), F.col("id") % 5000).alias("name"),
                                                F.when(F.col("id") % 4 == 0, F.col("id") / 2).alias("half"), F.expr("named_struct('x', id % 7)").alias("s")).coalesce(2)
    day(0, 6000).write.parquet(path)
    scan = spark.read.parquet(path)
    assert pr.update_profiles(spark, store, "t", scan) == 2
    first = {r.column_name: r for r in pr.merged_stats(spark, store, "t", "sch").collect()}
    assert pr.update_profiles(spark, store, "t", scan) == 0
    for f in _listing(path):    # the old day can't be read any more
        with open(f, "wb") as out:
            out.write(b"PAR1")
    day(4000, 10_000).write.mode("append").parquet(path)
    old = {"id", "few", "name", "half", "s"}
    scan = spark.read.schema(day(0, 1).schema).parquet(path)
    assert pr.update_profiles(spark, store, "t", scan) == 2
    both = {r.column_name: r for r in pr.merged_stats(spark, store, "t", "sch").collect()}
    assert first[None].row_count == 6000 and both[None].row_count == 12_000 and set(both) == old | {None}
    want = {r.column_name: r for r in st.column_stats(day(0, 6000).unionByName(day(4000, 10_000)), "sch", "t", exact=True).collect()}
    for name, w in want.items():
        r = both[name]
        assert (r.data_size, r.nulls_fraction, r.row_count, r.low_value, r.high_value, r.schema_name, r.table_name) == (w.data_size, w.nulls_fraction, w.row_count, w.low_value, w.high_value, "sch", "t")
        if name:
            assert abs(r.distinct_values_count - w.distinct_values_count) <= 0.05 * w.distinct_values_count + 1, name
    # files that have gone drop out
    kept = pr._files(scan)[:1]
    assert 0 < {r.column_name: r for r in pr.merged_stats(spark, store, "t", files=kept).collect()}[None].row_count < 12_000


def test_profiles_of_nothing(spark, tmp_out):
    assert [tuple(r) for r in pr.merged_stats(spark, f"{tmp_out}/none", "t").collect()] == [(None, None, None, None, 0.0, None, None)]
    spark.range(0).write.parquet(f"{tmp_out}/empty")
    pr.update_profiles(spark, f"{tmp_out}/store", "t", spark.read.parquet(f"{tmp_out}/empty"))
    assert pr.merged_stats(spark, f"{tmp_out}/store", "t").where("column_name is null").first().row_count == 0
