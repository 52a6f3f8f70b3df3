"""Ranked search: ball trees and whole results against brute force and the SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
from helpers import CLASH, SF, documents, edge_docs, edge_rows, no_docs
from pyspark.sql import functions as F

from whlens.llm import search as S

ITEMS = "item_id long, text string"


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, top=20):
    """docs and items: lists of (id, text); one item an id."""
    bags = [(key, Counter(words(t))) for key, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(words(text))
    out = []
    for item, query in asked.items():
        scored = []
        for key, bag in bags:
            m = 75 + (25 * sum(bag.values()) * n_docs) // n_terms if n_terms else 0
            s = sum(c * S.weight(n_docs, df[t]) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m)) for t, c in query.items() if t in bag)
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_terms():
    rng = random.Random(3)
    parts = ["A", "z", "é", "É", "9", " ", " ", " ", "\x1c", "\x85", "_", "-", "'", "日", "\U0001f600", "\n", "[", "\x7f", "ǅ", "İ"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert [w.decode() for w in S.terms(t)] == words(t)
    assert S.terms(None) == []


def test_tree_against_all_vectors():
    rng = np.random.default_rng(5)
    for n, width, leaf in ((1, 4, 2), (3, 5, 1), (400, 30, 8), (700, 200, 16)):
        w = rng.integers(1, 9000, width)
        idx = [np.sort(rng.choice(width, rng.integers(1, min(12, width) + 1), replace=False)) for _ in range(n)]
        val = [rng.integers(1, 10**6, len(i)) for i in idx]
        if n > 10:  # equal and nearly equal vectors
            for k in range(5, 60):
                idx[k], val[k] = idx[4], val[4].copy()
        indptr = np.concatenate([[0], np.cumsum([len(i) for i in idx])])
        tree = S.BallTree(indptr, np.concatenate(idx), np.concatenate(val), w, leaf)
        ids = [[(False, int(k))] for k in rng.permutation(n)]
        assert sorted(tree.rows) == list(range(n))
        for _ in range(20):
            query = {int(t): int(rng.integers(1, 4)) for t in rng.choice(width, min(width, 5), replace=False)}
            scores = [sum(query.get(int(t), 0) * int(w[t]) * int(v) for t, v in zip(i, x)) for i, x in zip(idx, val)]
            want = sorted((-s, ids[k][0]) for k, s in enumerate(scores) if s > 0)[:20]
            assert [(-s, key) for s, key in tree.search(query, ids)] == want


def test_bounds_prune():
    rng = np.random.default_rng(1)
    # Two far groups: a query of the one never opens the leaves of the other.
    idx = [np.array([0, 1]) if k % 2 else np.array([2, 3]) for k in range(512)]
    val = [rng.integers(900_000, 10**6, 2) for _ in range(512)]
    tree = S.BallTree(np.arange(513) * 2, np.concatenate(idx), np.concatenate(val), np.full(4, 1000), 16)
    tree.search({0: 1, 1: 1}, [[(False, k)] for k in range(512)])
    assert tree.opened <= 16


def test_whole_result_against_brute_force_and_sql(spark):
    docs, items = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = rows(S.op13_search(spark, SF))
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    assert got == sorted(con.sql(S.OP13_SQL).fetchall(), key=str)


def test_blocks_of_queries_and_small_shards(spark, monkeypatch):
    docs, items = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = rows(S.search(docs, items))
    assert rows(S.search(docs, items, block_terms=100)) == want
    assert rows(S.search(docs.repartition(13), items, top=3)) == [r for r in want if r[1] <= 3]


def test_edge_rows(spark):
    queries = [(1, "the LAZY dog dog"), (2, None), (3, "!!"), (None, "key without"), (4, "the"), (4, "日本語 fox"), (5, "wort3e mail other")]
    items = spark.createDataFrame(queries, ITEMS)
    for clash in (False, True):
        docs = edge_docs(spark, clash)
        asked = items
        if clash:
            for c in CLASH + ("item", "times", "doc_id", "block"):
                asked = asked.withColumn(c, F.lit("x"))
        got = rows(S.search(docs, asked))
        assert got == brute([(r[0], r[1]) for r in edge_rows()], queries)
        assert [r[2] for r in got if r[0] == 1][:2] == [1, 1]  # repeated rows are documents of their own
        assert {r[0] for r in got} == {1, None, 4, 5}


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert rows(S.search(no_docs(spark), none)) == rows(S.search(documents(spark), none)) == []
    assert rows(S.search(no_docs(spark), spark.createDataFrame([(1, "a b")], ITEMS))) == []
    assert rows(S.search(documents(spark), spark.createDataFrame([(1, "qqqqzz")], ITEMS))) == []


def test_many_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a common passage of text").otherwise(F.concat(F.lit("other text "), F.col("id").cast("string"))).alias("text"))
    got = rows(S.search(docs, spark.createDataFrame([(1, "common passage")], ITEMS)))
    assert sorted(r[2] for r in got) == [3 * i for i in range(20)]
