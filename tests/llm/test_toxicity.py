"""Toxicity: the automaton against edit distances, planted spellings and quotations, held-out accuracy."""

import random

import pytest
from helpers import DOCS, LONG, SF, edge_docs, no_docs
from pyspark.sql import functions as F

from whlens.llm import toxicity as T

LABELS = "doc_id long, toxic int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_against_edit_distances():
    rng = random.Random(1)
    for _ in range(30):
        text = lambda lo, hi: "".join(rng.choice("abc") for _ in range(rng.randint(lo, hi)))
        terms = sorted({(text(2, 9), rng.random() < 0.3) for _ in range(12)})
        auto = T.Automaton(terms)
        for _ in range(200):
            word = text(1, 11)
            want = {}
            for t, (term, stem) in enumerate(terms):
                e = min(distance(term, word[:k]) for k in range(len(word) + 1)) if stem else distance(term, word)
                if e <= T.allowed(term, stem):
                    want[t] = e
            assert auto._run(word) == want, (word, terms)


def test_disguises():
    auto = T.Automaton([("idiot", False), ("stupid", False), ("worthless", False)])
    assert auto.match("idiot") == ((0, 0),) and auto.match("IDIOT") == ((0, 0),)
    assert auto.match("1d10t") == auto.match("idiiiiot") == auto.match("idoit"[:3] + "ot") == ((0, 1),)
    assert auto.match("st@pid") == ((1, 1),) and auto.match("wortless") == ((2, 1),) and auto.match("worhtless") == ((2, 2),)
    assert auto.match("table") == () and auto.match("123") == ()


def test_memo_is_given_up_without_changing_results(monkeypatch):
    words = ["".join(random.Random(i).choices("idotmrn", k=6)) for i in range(400)]
    whole = T.Automaton([("idiot", False), ("moron", False), ("dimotr", True)])
    want = [whole.match(w) for w in words]
    monkeypatch.setattr(T, "MEMO", 7)
    small = T.Automaton(whole.terms)
    assert [small.match(w) for w in words] == want and len(small.words) <= 7


CLEAN = "the harbour opens early and the boats go out while people walk along the wall with their dogs in the wind you see".split()


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(CLEAN) for _ in range(rng.randint(15, 60))]
        kind = i % 3
        if kind == 0:  # abuse
            w.insert(rng.randrange(len(w)), f"you {rng.choice(['blatherskite', 'nincompoop', 'scoundrel'])}")
        elif kind == 1 and i % 2:  # the same words, quoted
            w.insert(rng.randrange(len(w)), f'he wrote the word "{rng.choice(["blatherskite", "nincompoop", "scoundrel"])}" in a report')
        docs.append((i, " ".join(w), "en", "a", 0))
        labels.append((i, int(kind == 0)))
    return docs, labels


@pytest.fixture(scope="module")
def planted(spark):
    docs, labels = corpus()
    docs = spark.createDataFrame(docs, DOCS)
    return T.train(docs, spark.createDataFrame(labels, LABELS))


def scores(spark, model, texts):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    return {r.doc_id: r for r in T.assess(docs, model).collect()}


def test_misspellings_and_quotations(spark, planted):
    base = " ".join(CLEAN)
    got = scores(spark, planted, [base, base + " you nincompoop", base + " you nincompop", base + " you n1nc0mpoop", base + " you scoundrrrrel", base + ' he wrote the word "nincompoop" in a report', "", None])
    assert [got[i].score >= 0.7 for i in range(8)] == [False, True, True, True, True, False, False, False]
    assert all(0 <= r.score <= 1 for r in got.values())
    span = got[2].spans[0]
    assert (base + " you nincompop")[span.start:span.end] == "nincompop" and span.term == "nincompoop" and span.edits == 1
    assert got[5].spans[0].abuse < got[1].spans[0].abuse


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    got = T.op11_toxicity(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    seen = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    english = [r for r in seen if r.lang == "en"]
    assert sum(r.predicted for r in seen if r.toxic == 0) <= 0.02 * len(seen)
    assert sum(r.predicted for r in english if r.toxic) >= 0.8 * sum(r.toxic for r in english)


def test_labels_of_held_out_rows_are_not_read(spark, tmp_out):
    docs, labels = corpus(300)
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_out}/documents.parquet")
    held = {r.id for r in spark.range(300).where(F.crc32(F.col("id").cast("string")) % 3 == 1).collect()}
    results = []
    for k, flip in enumerate((False, True)):
        spark.createDataFrame([(i, 1 - t if flip and i in held else t) for i, t in labels], LABELS).write.mode("overwrite").parquet(f"{tmp_out}/labels.parquet")
        results.append(sorted(map(tuple, T.op11_toxicity(spark, tmp_out).collect())))
    assert results[0] == results[1]
    assert {r[0] for r in results[0] if r[1]} == held


def test_edge_rows(spark, planted):
    for clash in (False, True):
        out = T.assess(edge_docs(spark, clash), planted).collect()
        assert len(out) == edge_docs(spark).count() and all(0 <= r.score <= 1 for r in out)
    assert T.assess(no_docs(spark), planted).collect() == []
    text = LONG + " you nincompoop"
    assert scores(spark, planted, [text])[0].spans[-1].end == len(text)


def test_without_classes_or_terms(spark):
    docs = edge_docs(spark)
    for labels, prior in (([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (None, 1), (2, None)], 0.0), ([(1, 1), (2, 0), (1, 0)], 1 / 2)):
        model = T.train(docs, spark.createDataFrame(labels, LABELS))
        out = T.assess(docs, model).collect()
        assert len(out) == docs.count() and {round(r.score, 9) for r in out} == {round(prior, 9)}


def test_sample_is_bounded(spark):
    docs, labels = corpus(300)
    rows = T._sample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), 40)
    assert {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()} == {0: 40, 1: 40}
