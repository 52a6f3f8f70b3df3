"""Language ID on held-out documents, and mixing against a raking in numpy."""

import zlib
from functools import reduce

import numpy as np
import pytest
from helpers import LONG, documents, edge_docs, no_docs
from pyspark.sql import Window
from pyspark.sql import functions as F

from whlens.llm import langid, mixing


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = langid.op2_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(found) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    out = [r for r in found if r.held_out]
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.98
    assert all(0 <= r.score <= 1 for r in found) and not any(r.rejected for r in found)


def test_counts_are_those_of_the_whole_text(monkeypatch):
    texts = ["Ab á 12 c" * 40, None, "", "7 !", "x", LONG[:5000]]
    whole = langid.ngram_counts(texts)
    monkeypatch.setattr(langid, "PIECE", 37)
    assert np.array_equal(whole, langid.ngram_counts(texts))
    assert np.array_equal(whole, np.concatenate([langid.ngram_counts([t]) for t in texts]))
    assert whole.sum(axis=1)[1:4].tolist() == [0, 0, 0] and whole[4].sum() == 3
    s = " " + "".join(c if c.isalpha() else " " for c in texts[0].lower())
    while "  " in s:
        s = s.replace("  ", " ")
    s = s[1:] if not texts[0][0].isspace() else s
    assert whole[0].sum() == sum(c != " " for c in s) + 2 * len(s)


def test_learns_nothing_from_held_out_documents(spark):
    rows = [(i, ("der die und ist nicht " if i % 2 else "the and of with that ") * 5, "de" if i % 2 else "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    lies = docs.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang")))
    model = langid.train(lies.where(~langid.held_out()))
    assert set(model.langs) == {"de", "en"}
    other = model.predict(["ДЛИННЫЙ текст на другом языке и ещё слова " * 30, "the and of", "that", None, "1 2"])
    assert [r[2] for r in other] == [True, False, False, True, True] and [r[0] for r in other[3:]] == ["und", "und"] and other[4][1] == 0


def test_language_of_edges(spark):
    docs = edge_docs(spark, clash=True)
    found = langid.identify(docs, langid.train(docs))
    assert found.count() == docs.count()
    und = {r.doc_id for r in found.where("lang_pred = 'und'").collect()}
    assert und == {3, 4, 6, 7, None}
    kept = langid.known_language(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes and 3 not in {r.doc_id for r in kept.collect()}
    empty = no_docs(spark)
    assert langid.identify(empty, langid.train(empty)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.train(empty)).collect()} == {"und"}


# Mixing.

@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{s}" if s else None, lang, t, int(rng.integers(50, 5000)) * (9 if s == 1 else 1)) for s in range(5) for lang in ("en", "de", None) for t in range(4)]
    return spark.createDataFrame(rows, "source string, lang string, topic int, tokens long")


def brute_rake(rows, targets, sweeps=200):
    w = np.array([r[3] for r in rows], float)
    for _ in range(sweeps):
        for k, goal in enumerate(targets):
            total = sum(goal.values())
            for value, share in goal.items():
                at = np.array([r[k] == value for r in rows])
                w[at] *= share / total / w[at].sum()
    return w


def test_rake_meets_all_targets(spark, cells):
    rows = [tuple(r) for r in cells.collect()]
    targets = {m: mixing.tempered(cells, m) for m in mixing.MARGINS}
    goals = [{r.value: r.share for r in targets[m].collect()} for m in mixing.MARGINS]
    want = dict(zip([r[:3] for r in rows], brute_rake(rows, goals)))
    found = mixing.rake(cells, targets).collect()
    assert len(found) == len(rows)
    for r in found:
        assert np.isclose(r.weight, want[(r.source, r.lang, r.topic)], rtol=1e-3)


def test_given_targets_and_absent_values(spark, cells):
    goal = spark.createDataFrame([("en", 3.0), ("de", 1.0), ("xx", 9.0)], "value string, share double")
    targets = {m: mixing.tempered(cells, m) for m in mixing.MARGINS} | {"lang": goal}
    by = {r.lang: r.w for r in mixing.rake(cells, targets).groupBy("lang").agg(F.sum("weight").alias("w")).collect()}
    assert np.isclose(by["en"], 0.75, rtol=1e-3) and np.isclose(by["de"], 0.25, rtol=1e-3) and by[None] == 0


@pytest.mark.parametrize("budget", [0.05, 0.6, 0.95])
def test_probabilities_meet_the_budget(spark, cells, budget):
    raked = mixing.rake(cells, {m: mixing.tempered(cells, m) for m in mixing.MARGINS})
    rows = mixing.calibrate(raked, budget).collect()
    total = sum(r.tokens for r in rows)
    assert np.isclose(sum(r.tokens * r.probability for r in rows), budget * total, rtol=1e-6)
    open_ = [r.tokens * r.probability / r.weight for r in rows if r.probability < 1]
    assert np.allclose(open_, open_[0]) and all(0 < r.probability <= 1 for r in rows)
    assert all(r.tokens / r.weight <= open_[0] * (1 + 1e-9) for r in rows if r.probability == 1)


def test_sample_of_documents(spark, monkeypatch):
    docs = documents(spark)
    found = mixing.mix(docs, budget=0.5).collect()
    assert len(found) == 200 and 0 < sum(r.kept for r in found) < 200
    assert {r.doc_id for r in mixing.mixed(docs, budget=0.5).collect()} == {r.doc_id for r in found if r.kept}
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 0)  # the salted join
    assert sorted(map(str, mixing.mix(docs, budget=0.5).collect())) == sorted(map(str, found))


def test_mixing_of_edges(spark):
    docs = edge_docs(spark, clash=True)
    found = mixing.mix(docs).collect()
    assert len(found) == docs.count() and {r.topic for r in found if r.doc_id in (3, 4, 6)} == {-1}
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in found if r.kept)
    assert mixing.mix(no_docs(spark)).count() == 0 and mixing.mixed(no_docs(spark)).count() == 0


def test_topics_are_fitted_on_every_document(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{t}_{w}" for w in rng.integers(0, 40, 12)) for t in rng.integers(0, 8, 4000)]
    docs = spark.createDataFrame([(i, t, "s", "l") for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string").repartition(5)
    counts = mixing.word_counts(texts)[0]
    idf = np.log((1 + len(texts)) / (1 + (counts > 0).sum(axis=0))) + 0.1
    x = langid.unit(langid.damped(counts) * idf)
    want = (x @ langid.kmeans(x, mixing.TOPICS).T).argmax(axis=1)
    found = {r.doc_id: r.topic for r in mixing.mix(docs).collect()}
    assert [found[i] for i in range(len(texts))] == want.tolist()


def test_few_cells_are_raked_without_a_shuffle(spark):
    cells = spark.createDataFrame([(f"s{i % 5}", f"l{i % 3}", i % 4, 1 + i * 7 % 50) for i in range(60)], "source string, lang string, topic int, tokens long")
    cells = mixing.together(cells.groupBy(*mixing.MARGINS).agg(F.sum("tokens").alias("tokens")))
    summed = reduce(lambda df, m: df.withColumn(f"by_{m}", F.sum("tokens").over(Window.partitionBy(m))), mixing.MARGINS, cells)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert summed.count() and plan.count("Exchange hashpartitioning") == 1  # that of the groupBy
