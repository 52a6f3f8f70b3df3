"""Licence scans with a positional index of rare words, in DataFrame functions only.

One pass over the texts keeps, of each document, the places of words that licence
templates use. Document frequencies of those words, over all documents, give their
IDF. The highest-IDF words of each template's mandatory phrases are its postings
(word -> template, position); a document's words that agree on where a template would
start vote for that start. A template counts if its mandatory phrases stand there word
by word, and then all its postings vote for it, whatever else the document holds.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from whlens.llm.common import lower_ascii, table

# Base phrases, and passages of well-known licence texts and notices
# with the phrases that must stand in them.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
TEMPLATES = [
    ("mit", "released under the mit license", ["released under", "mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["hereby granted free", "associated documentation files"]),
    ("apache", "licensed under the apache license version 2 0", ["licensed under", "apache license version 2 0"]),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ["licensed under", "apache license version 2 0"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["licensed under", "gnu general public license version"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license", "free software foundation"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ["gnu affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["binary forms", "without modification", "permitted provided"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["licensed under cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["licensed under cc by sa"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights", ["waived all copyright", "neighboring rights"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software released", "public domain"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["distribute this software", "without fee", "hereby granted"]),
]
#: A template's words that are looked up, and the votes that a start needs.
RARE_WORDS, MIN_VOTES = 8, 3
#: Shorter template words are indexed only if a mandatory phrase has them.
MIN_LETTERS = 4

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Index:
    """Vocabulary, postings and mandatory phrases of the templates."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        self.base, self.labels = base, [label for label, _, _ in templates]
        bound = {w for _, _, phrases in templates for p in phrases for w in p.split()} | {w for p in base.values() for w in p.split()}
        keep = lambda w: len(w) >= MIN_LETTERS or w in bound
        texts = [text.split() for _, text, _ in templates]
        self.words = sorted({w for t in texts for w in t if keep(w)} | bound)
        self.id = {w: i for i, w in enumerate(self.words)}
        self.postings = [[(t, at) for t, text in enumerate(texts) for at, w in enumerate(text) if w == word] for word in self.words]
        self.places = [[(at, self.id[w]) for at, w in enumerate(text) if w in self.id] for text in texts]
        self.phrases = []
        for (_, _, phrases), text in zip(templates, texts):
            need = []
            for p in phrases:
                p = p.split()
                at = next(i for i in range(len(text)) if text[i:i + len(p)] == p)
                need += [(at + k, self.id[w]) for k, w in enumerate(p)]
            self.phrases.append(need)


def licence_words(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, n_words, hits): ``hits`` are (pos, id) of the index's words, in order."""
    words = F.array_remove(F.split(F.coalesce(lower_ascii(F.col("text").cast("string")), F.lit("")), NOT_WORD), "")
    split = docs.select("doc_id", words.alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))), lambda h: h["word"].isin(index.words))
    known = F.array(*[F.lit(w) for w in index.words])
    hits = F.transform(hits, lambda h: F.struct(h["pos"].cast("int").alias("pos"), (F.array_position(known, h["word"]) - 1).cast("int").alias("id")))
    return split.select("doc_id", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))


def _phrase_places(index: Index, phrase: str) -> Column:
    """Where the phrase's words stand consecutively. All of them are index words, so
    they are neighbours in ``hits``."""
    hit = lambda j: F.get("hits", j)

    def here(j: Column) -> Column:
        first, *rest = phrase.split()
        tests = [hit(j)["id"] == index.id[first]]
        for k, w in enumerate(rest, 1):
            tests += [hit(j + k)["id"] == index.id[w], hit(j + k)["pos"] == hit(j)["pos"] + k]
        return reduce(lambda a, b: a & b, tests)

    at = F.filter(F.when(F.size("hits") > 0, F.sequence(F.lit(0), F.size("hits") - 1)).otherwise(F.array().cast("array<int>")),
                  lambda j: F.coalesce(here(j), F.lit(False)))
    return F.transform(at, lambda j: hit(j)["pos"])


def _voters(index: Index, idf: list[float], rare_words: int, min_votes: int) -> list[list[tuple[int, int]]]:
    """Postings (template, position) by word: each template's rarest places of its
    mandatory phrases, or all its places if those are too few to agree."""
    out = [[] for _ in index.words]
    for t, need in enumerate(index.phrases):
        places = sorted(set(need), key=lambda q: (-idf[q[1]], q))[:max(rare_words, min_votes)]
        for at, i in places if len(places) >= min_votes else index.places[t]:
            out[i].append((t, at))
    return out


def _votes(index: Index, idf: list[float], rare_words: int, min_votes: int) -> Column:
    """(template, start) of each vote, in order."""
    voters = _voters(index, idf, rare_words, min_votes)
    postings = F.array(*[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(at).alias("at")) for t, at in p]) if p
                         else F.array().cast("array<struct<t:int,at:int>>") for p in voters])
    return F.sort_array(F.flatten(F.transform(
        F.filter("hits", lambda h: h["id"].isin([i for i, p in enumerate(voters) if p])),
        lambda h: F.transform(F.get(postings, h["id"]), lambda p: F.struct(p["t"].alias("t"), (h["pos"] - p["at"]).alias("start"))))))


def scan(docs: DataFrame, index: Index | None = None, rare_words: int = RARE_WORDS, min_votes: int = MIN_VOTES) -> DataFrame:
    """Licences of each whole text (null: empty).

    Returns doc_id, n_words, n_base, first_word, last_word (starts of base phrases,
    null without one), base_labels, labels (comma-joined, '' if none) and score, the
    best verified template's share of its words found in place, weighted by IDF (0
    without one). Rows of one doc_id are rows of their own. No rows, no result.
    """
    index = index or Index()
    found = table(licence_words(docs, index), "licence-words")
    # Bounded by the templates' vocabulary.
    df = {r["id"]: r["n"] for r in found.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["id"]))).alias("id"))
          .groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = found.count()
    idf = [math.log((n + 1) / (df.get(i, 0) + 1)) + 1e-9 for i in range(len(index.words))]

    out = found.select("*", *[_phrase_places(index, p).alias(f"base_{k}") for k, p in enumerate(index.base.values())])
    places = F.concat(*[f"base_{k}" for k in range(len(index.base))])
    base = F.filter(F.array(*[F.when(F.size(f"base_{k}") > 0, F.lit(label)) for k, label in enumerate(index.base)]), lambda x: x.isNotNull())
    out = out.select("doc_id", "n_words", "hits", places.alias("places"), base.alias("base"), _votes(index, idf, rare_words, min_votes).alias("votes"))
    m = min_votes - 1
    agreed = F.filter(F.when(F.size("votes") > m, F.sequence(F.lit(0), F.size("votes") - 1 - m)).otherwise(F.array().cast("array<int>")),
                      lambda j: F.get("votes", j) == F.get("votes", j + m))
    out = out.withColumn("starts", F.array_distinct(F.transform(agreed, lambda j: F.get("votes", j))))

    need = F.array(*[F.array(*[F.struct(F.lit(a).alias("pos"), F.lit(i).alias("id")) for a, i in p]) for p in index.phrases])
    text = F.array(*[F.array(*[F.struct(F.lit(a).alias("pos"), F.lit(i).alias("id")) for a, i in p]) for p in index.places])
    total = F.array(*[F.lit(sum(idf[i] for _, i in p)) for p in index.places])
    weight = F.array(*[F.lit(x) for x in idf])

    def in_place(words: Column, start: Column) -> Column:
        """Those of the (position in template, id) that the document has there."""
        return F.array_intersect(F.transform(words, lambda q: F.struct((q["pos"] + start).alias("pos"), q["id"].alias("id"))), F.col("hits"))

    whole = F.filter("starts", lambda s: F.size(in_place(F.get(need, s["t"]), s["start"])) == F.size(F.array_distinct(F.get(need, s["t"]))))
    names = F.array(*[F.lit(x) for x in index.labels])
    out = out.withColumn("whole", whole)
    label = F.transform("whole", lambda s: F.get(names, s["t"]))
    share = F.transform("whole", lambda s: F.aggregate(
        in_place(F.get(text, s["t"]), s["start"]), F.lit(0.0), lambda a, q: a + F.get(weight, q["id"])) / F.get(total, s["t"]))
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", label)), ",").alias("labels"),
        F.least(F.coalesce(F.array_max(share), F.lit(0.0)), F.lit(1.0)).alias("score"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
