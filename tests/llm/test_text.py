"""Licences, personal data and quality rules against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from helpers import LONG, documents, edge_docs, no_docs, words

from whlens.llm import licenses, pii, quality

EXTRA = [
    "Licensed under the Apache License, Version 2.0.", "apache license mit license MIT LICENSE; the (general) public-license",
    "This work is licensed under the GNU General Public License, version 3. And more: GNU General Public License",
    "Licensed under CC BY-NC 4.0.", "licensed under cc by", "Released under the MIT License.", "mit\nlicense", "mit élicense mit_license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
    "associated documentation files hereby granted free", "no words of it",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
]


def with_texts(spark, docs, texts):
    rows = [(1000 + i, t, "en", "x", len(t)) for i, t in enumerate(texts)]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


# Licences.

def brute_licence(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = {}
    for label, phrase in licenses.BASE.items():
        p = phrase.split()
        places[label] = [i for i in range(len(w)) if w[i:i + len(p)] == p]
    return w, places


def test_licences(spark):
    docs = with_texts(spark, documents(spark).unionByName(edge_docs(spark)), EXTRA)
    found = licenses.scan(docs).collect()
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    assert len(found) == docs.count()
    for r in found:
        fits = []
        for text in texts[r.doc_id]:
            w, places = brute_licence(text)
            every = sorted(i for p in places.values() for i in p)
            fits.append((len(w), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(k for k, p in places.items() if p))))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) in fits
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) <= bool(r.labels)
    got = {r.doc_id: r.labels for r in found if r.doc_id and r.doc_id >= 1000}
    assert [got[1000 + i] for i in range(len(EXTRA))] == ["apache", "apache,gpl,mit", "gpl", "cc-by-nc", "", "mit", "mit", "mit", "mit", "", "", "bsd"]


def test_alignments_against_all_starts(spark):
    """Each label that the index adds is a template whose phrases stand at one start, and the other way round."""
    index, rng = licenses.Index(), random.Random(2)
    pieces = [t for _, t, _ in licenses.TEMPLATES]
    texts = []
    for _ in range(60):
        w = " ".join(rng.choice(pieces) for _ in range(rng.randint(1, 2))).split()
        for _ in range(rng.choice([0, 0, 1, 3, 8])):
            w[rng.randrange(len(w))] = rng.choice(["the", "of", "licence", "x9"])
        texts.append("one two " + " ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(docs, index, rare_words=len(index.words)).collect()}
    for i, text in enumerate(texts):
        w, places = brute_licence(text)
        want = {k for k, p in places.items() if p}
        for t, label in enumerate(index.labels):
            for start in range(-60, len(w)):
                here = lambda q: 0 <= start + q[0] < len(w) and w[start + q[0]] == index.words[q[1]]  # noqa: B023, E731
                if all(map(here, index.phrases[t])) and sum(map(here, index.places[t])) >= licenses.MIN_VOTES:
                    want.add(label)
        assert set(filter(None, found[i].labels.split(","))) == want, text


def test_every_licence_of_a_long_file(spark):
    """With production parameters: all templates beside each other, and among chance uses of all their words."""
    pieces = [t for _, t, _ in licenses.TEMPLATES]
    chance = sorted({w for t in pieces for w in t.split()})
    texts = [" x1 ".join(pieces[at:] + pieces[:at]) for at in range(len(pieces))]
    texts += [" x1 ".join(chance) + " x1 " + t + " x1 " + " x1 ".join(chance) for t in pieces]
    texts += [pieces[0]] * 40 + ["nothing of it"] * 20  # a hot source: its notice's words are common
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(docs).collect()}
    every, n = {label for label, _, _ in licenses.TEMPLATES}, len(pieces)
    assert all(found[i] == every for i in range(n))
    assert all(licenses.TEMPLATES[i][0] in found[n + i] for i in range(n)) and found[2 * n] == {"mit"}


def test_licences_of_nothing(spark):
    assert licenses.scan(no_docs(spark)).count() == 0
    assert licenses.scan(edge_docs(spark, clash=True)).count() == 12


# Personal data.

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(d := re.sub("[^0-9]", "", s)) <= 19 and pii.luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
]


def brute_spans(text):
    return [(k, m.start(), m.end()) for k, p, ok in PATTERNS for m in re.finditer(p, text or "") if ok(m.group())]


def test_base_spans_of_random_strings():
    rng = random.Random(5)
    parts = list("a.@-+%_ ()0159é\n") + ["4111111111111111", "192.168.1.1", "a@b.co", "+1 (555) 555-1234", "4111 1111-1111 1111", "1.2.3.4.5", "@@", "..", "a@b", "256.1.1.1", "٣"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == brute_spans(text), repr(text)


def test_long_runs_take_linear_time():
    import time
    began = time.time()
    for text in ("1" * 300_000, "a" * 300_000 + "@", "a." * 150_000, "+1" * 150_000, "1." * 150_000, "@" * 300_000, "a1-" * 100_000):
        pii.candidates(text)
    assert time.time() - began < 20


def test_spans_of_documents(spark):
    docs = documents(spark).unionByName(edge_docs(spark))
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    found = pii.find(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        base = [brute_spans(t) for t in texts[r.doc_id]]
        assert r.base in [",".join(f"{k}:{a}:{b}" for k, a, b in spans) for spans in base]
        assert r.spans.startswith(r.base) and r.n_email == r.base.count("email:") and r.n_phone == r.base.count("phone:")
    from whlens.llm.pii import op6_personal_data
    row = op6_personal_data(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(texts[0][0])).encode()).hexdigest()


def test_votes_teach_the_classifier(spark):
    rng = random.Random(4)
    hexa = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'some words and token = "{hexa()}" then more' if i % 2 else f"about {rng.randint(10**9, 10**10)} items, see page-{i}-of-the-long-list-here") for i in range(300)]
    rows += [(1000 + i, f"write to x{i}@example.com or call +1 (555) 555-1{i:03d}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert all(found[i].startswith("secret:24:64") for i in range(1, 300, 2))
    assert sum("secret" in found[i] for i in range(0, 300, 2)) == 0 and sum("account" in found[i] for i in range(0, 300, 2)) == 0
    clean = {r.doc_id: r.text for r in pii.without_personal_data(docs).collect()}
    assert clean[1] == 'some words and token = "<secret>" then more' and clean[1001] == "write to <email> or call <phone>"


def test_estimates_follow_reliable_labelers():
    good, bad = {}, {}
    for k, v in {(1, 1, 1, 0): 80, (1, 0, 1, 0): 20, (-1, -1, 0, 0): 90, (-1, 0, -1, 0): 10}.items():
        good[("secret", k)] = v
    found = pii.estimate(good)
    assert found[("secret", (1, 0, 1, 0))] > 0.9 > 0.1 > found[("secret", (-1, 0, -1, 0))]
    assert pii.estimate(bad) == {}


def test_redaction():
    assert pii.redact("ab cd ef", [("x", 3, 5)]) == "ab <x> ef"
    assert pii.redact("abcdef", [("x", 0, 3), ("y", 2, 5), ("z", 5, 6)]) == "<x><z>"
    assert pii.redact(None, []) is None


def test_personal_data_of_edges(spark):
    docs = edge_docs(spark, clash=True)
    clean = pii.without_personal_data(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    rows = {r.doc_id: r for r in clean.collect()}
    assert rows[5].text == LONG.replace("a.b@c.example.org", "<email>") and rows[5].n_chars == len(rows[5].text)
    assert rows[3].text is None and rows[4].text == ""
    assert pii.find(no_docs(spark)).count() == 0 and pii.without_personal_data(no_docs(spark)).count() == 0


# Quality.

def brute_statistics(text):
    text = text or ""
    w = words(text)
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    texts = ["a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "x\n\nx\r\nx \n x\n\t\n", "é é #*$%&|<> \x0b\x0c z\x1c\x85\xa0q", " ".join("ab"[i * i % 7 % 2] for i in range(80))]
    docs = with_texts(spark, documents(spark).unionByName(edge_docs(spark)), texts)
    want = collections.defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(brute_statistics(r.text))
    found = quality.judge(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got in want[r.doc_id]
        assert r.base_failed == (got[0] < 20 or 100 * got[4] > 30 * got[0]) and not (r.base_failed and r.kept)


@pytest.fixture(scope="module")
def cloud(spark):
    """Two groups, one of them hot, with a tenth of far outliers."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(2600):
        hot = i < 2000
        words_, length = int(np.exp(rng.normal(5 if hot else 6.5, 0.5))) + 20, rng.normal(5.2, 0.2)
        odd = i % 10 == 0
        rows.append((i, "en" if hot else "de", "big" if hot else f"s{i % 40}", words_, int(words_ * length), int(words_ * 3) if odd else 0, 10, 0, 0, odd))
    return spark.createDataFrame(rows, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, odd boolean")


def test_outliers_are_those_planted(spark, cloud):
    rows = quality.grouped(quality.transformed(cloud.withColumn("base_failed", quality.base_failed())), 200)
    assert rows.select("grp").distinct().count() == 2 and rows.count() == 2600  # the small sources are one group
    found = quality.estimate(rows)
    far = {r.doc_id: r.d2 / r.scale > quality.CUTOFF for r in quality.distances(rows, found).select("doc_id", "d2", "scale").collect()}
    assert far == {r.doc_id: r.odd for r in cloud.collect()}


def test_repeated_lines_or_words_alone_reject(spark):
    """Documents of equal size and word length: menu lines or repeated passages between
    unique text go, one passage given twice stays."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    text = lambda n, per: [" ".join(word() for _ in range(per)) for _ in range(n // per)]
    rows = ["\n".join(text(240, 8)) for _ in range(400)]
    menus = ["\n".join(x for line in text(216, 9) for x in (line, "Reply")) for _ in range(5)]
    logs = ["\n".join([*["Share"] * 215, *text(25, 5)]) for _ in range(5)]
    passages = []
    for _ in range(5):
        twice = " ".join(text(35, 35))
        passages.append("\n".join(["one " + twice, *text(170, 10), "two " + twice + " end"]))
    clean = []
    for _ in range(5):
        line = " ".join(text(24, 24))
        clean.append("\n".join([line, *text(192, 8), line]))
    texts = rows + menus + logs + passages + clean
    docs = spark.createDataFrame([(i, t, "en", "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(found[i].kept for i in range(400)) and all(found[i].kept for i in range(415, 420))
    assert all(not found[i].kept and not found[i].base_failed for i in [*range(400, 405), *range(410, 415)])
    assert not any(found[i].kept for i in range(405, 410))


def test_estimates_are_those_of_the_nearest(spark, cloud):
    """One concentration step against numpy."""
    rows = quality.grouped(quality.transformed(cloud.withColumn("base_failed", quality.base_failed())), 200).where("lang = 'en'")
    d = len(quality.X)
    x = np.array(rows.select(*quality.X).collect())
    start = rows.groupBy("grp").count().selectExpr("grp", "0 as start", *[f"double({float(np.median(x[:, i]))}) as m_{i}" for i in range(d)],
                                                   *[f"double({0.7 if i == j else 0.05}) as l_{i}_{j}" for i in range(d) for j in range(i + 1)], "0.0d as log_det")
    got = quality.concentrate(rows, start).first()
    low = np.array([[0.7 if i == j else 0.05 if j < i else 0 for j in range(d)] for i in range(d)])
    d2 = (np.linalg.solve(low, (x - np.median(x, axis=0)).T) ** 2).sum(axis=0)
    bins = np.floor(quality.BINS * np.log2(d2 + 1e-6))
    last = np.sort(bins)[int(np.ceil(quality.COVERED * len(x))) - 1]
    near = x[bins <= last]
    cov = np.cov(near.T, bias=True) + np.diag([v * v for v in quality.FLOORS.values()])
    assert np.allclose([got[f"m_{i}"] for i in range(d)], near.mean(axis=0))
    assert np.allclose([[got[f"l_{i}_{j}"] if j <= i else 0 for j in range(d)] for i in range(d)], np.linalg.cholesky(cov))
    assert np.isclose(got.log_det, np.linalg.slogdet(cov)[1])


def test_quality_of_edges(spark):
    docs = edge_docs(spark, clash=True)
    found = quality.judge(docs)
    assert found.count() == docs.count() and {r.doc_id for r in found.where("kept").collect()} == {1, 2}
    assert quality.judge(no_docs(spark)).count() == 0


def test_no_python_on_the_main_path(spark):
    for query in (licenses.op4_licenses, quality.op7_quality):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas", plan)
