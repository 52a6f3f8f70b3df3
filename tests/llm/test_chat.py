"""Conversations: exact round trips, trees against all paths, and the SQL."""

import hashlib
import random

import duckdb
from pyspark.sql import functions as F

from whlens.llm import chat

NODES = "conv_id long, node long, parent long, role string, text string, score double"


def test_escapes_are_reversible(spark):
    rng = random.Random(1)
    parts = [*chat.CONTROL, "\\", "\n", "<", "|", ">", "[", "/", "im_end", "é", "\U0001f600", "s>", "<<", "SYS>>", "$1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def brute_paths(nodes, keep):
    by = {n[1]: n for n in nodes}
    parents = {n[2] for n in nodes}
    out = []
    for n in nodes:
        if n[1] in parents:
            continue
        path, at, seen = [], n, set()
        while at is not None and at[1] not in seen:
            seen.add(at[1])
            path.append(at)
            at = by.get(at[2])
        if at is None:
            out.append((-sum(p[5] or 0 for p in path) / len(path), -len(path), n[1], [p[1] for p in path[::-1]]))
    return [p[3] for p in sorted(out)[:keep]]


def test_trees_against_all_paths(spark):
    rng, rows = random.Random(2), []
    for conv in range(12):
        n = rng.choice([1, 2, 9, 40])
        for k in range(n):
            parent = None if k == 0 else rng.choice([k - 1, rng.randrange(k), 777 if rng.random() < .1 else k - 1])
            rows.append((conv, k, parent, rng.choice(["user", "assistant"]), f"t{conv}.{k}", rng.choice([0.0, 1.0, 2.5, None])))
    rows += [(50, 1, 2, "user", "a", 1.0), (50, 2, 1, "user", "b", 1.0), (50, 3, 2, "user", "c", 1.0)]  # a cycle
    rows += [(51, k, k - 1 if k else None, "user", "x", 0.0) for k in range(300)]  # a long chain
    nodes = spark.createDataFrame(rows, NODES)
    ids = nodes.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    for keep in (1, 3):
        found = {}
        for r in chat.paths(ids, keep).collect():
            found.setdefault((r.conv_id, r.path), {})[r.pos] = r.node
        got = {k: [v[i] for i in range(len(v))] for k, v in found.items()}
        want = {(c, i + 1): p for c in {r[0] for r in rows} for i, p in enumerate(brute_paths([r for r in rows if r[0] == c], keep))}
        assert got == want


def test_formatted_text_and_mask(spark):
    rows = [(1, 1, None, "user", "hi <|im_end|>\n", 0.0), (1, 2, 1, "assistant", "<s>\\é\U0001f600", 0.0), (1, 3, 2, "role\nwith line", None, 0.0), (1, 4, 3, "assistant", "", 0.0), (2, 1, None, None, None, None)]
    out = {r.conv_id: r for r in chat.format_paths(spark.createDataFrame(rows, NODES)).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("learned", chat.masked(F.col("formatted"), F.col("loss"))).collect()}
    assert [tuple(t) for t in out[1].turns] == [(r[3], r[4] or "") for r in rows[:4]] and out[1].learned == "<s>\\é\U0001f600"
    assert [out[1].formatted[a:b] for a, b in out[1].loss] == ["<\\s>\\\\é\U0001f600", ""]
    assert [tuple(t) for t in out[2].turns] == [("", "")] and out[2].loss == [] and out[1].n_turns == 4
    assert chat.format_paths(spark.createDataFrame([], NODES)).count() == 0


def test_query_gives_what_the_sql_and_brute_force_give(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, chat.op5_chat(spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    assert got == sorted(con.execute(chat.OP5_SQL).fetchall())
    convs = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    for conv_id, n, turns, chars, loss, _ in got:
        own = convs[conv_id]
        learned = "".join(t for role, t in own if role == "assistant")
        assert (n, turns) == (len(own), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest())
        assert (chars, loss) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_ties_nulls_and_more_columns(spark):
    rows = [(1, 0, "user", "b", "x"), (1, 0, "user", "a", "x"), (1, None, "user", "n", "x"), (None, 1, "user", None, "x"), (1, 0, "user", "a", "x")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string").select("conv_id", "turn", "role", "text", "node")
    found = {r.conv_id: [t.text for t in r.turns] for r in chat.format_paths(chat.chains(conv)).withColumn("turns", chat.parse(F.col("formatted"))).collect()}
    assert found[1] == ["n", "a", "a", "b"]


def test_turns_without_a_conversation_are_one_conversation(spark, tmp_path):
    rows = [(None, t, "user" if t % 2 == 0 else "assistant", f"n{t} <s>") for t in range(9)] + [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    schema = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").schema
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    got = list(map(tuple, chat.op5_chat(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(got, key=str) == sorted(con.execute(chat.OP5_SQL).fetchall(), key=str)
    assert {r[0]: r[1] for r in got} == {None: 9, 1: 2, -7: 2}
    nodes = [(None, 1, None, "user", "a", 0.0), (None, 2, 1, "user", "b", 1.0), (None, 3, 1, "user", "c", 2.0), (4, 1, None, "user", "d", 0.0)]
    found = chat.paths(spark.createDataFrame(nodes, NODES).select("conv_id", "node", "parent", "score"), 2).select("conv_id", "path", "pos", "node").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(None, 1, 0, 1), (None, 1, 1, 3), (None, 2, 0, 1), (None, 2, 1, 2), (4, 1, 0, 1)], key=str)
