"""Language identification: normalised TF-IDF vectors of character n-grams against
several clustered centroids per language, by cosine, with a distance threshold."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from whlens.llm.common import arrow_schema, drop, slices, table, text_batches

BUCKET_BITS = 12
#: Fit on about this many documents of each language (chosen by a hash of doc_id).
FIT_ROWS = 400
CLUSTERS = 4
UNKNOWN = "und"
#: A text is rejected if its cosine is below this share of what the training
#: sample's least similar half percent has; that is less for a text of fewer than
#: FULL_GRAMS n-gram buckets, as the square root of their number.
REJECT_SHARE, REJECT_QUANTILE, FULL_GRAMS = 0.5, 0.005, 400
PIECE = 1 << 18


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points; each run of others than letters is one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(32))
    return codes[~((codes == 32) & (np.concatenate([[np.uint32(0)], codes[:-1]]) == 32))]


def ngram_counts(texts: list[str | None]) -> np.ndarray:
    """Hashed counts of 1- to 3-grams, a row per text. Long texts are counted piece
    by piece; nothing is cut off."""
    width = 1 << BUCKET_BITS
    out = np.zeros(len(texts) * width)

    def count(rows: list[int], pieces: list[np.ndarray]) -> None:
        c = np.concatenate(pieces)
        row = np.repeat(rows, [len(p) for p in pieces])
        own = np.ones(len(c), bool)  # two codes of context lead each piece
        starts = np.cumsum([0, *map(len, pieces[:-1])])
        own[starts] = own[starts + 1] = False
        h = np.zeros(len(c), np.uint32)
        for n, k in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)):
            h[n:] += (c[:len(c) - n] + np.uint32(1)) * np.uint32(k)
            g = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
            g = (g ^ (g >> np.uint32(13))) * np.uint32(0x297A2D39)
            at = own if n else own & (c != 32)
            flat = row[at] * width + (g[at] >> np.uint32(32 - BUCKET_BITS))
            low, high = int(row[0]) * width, (int(row[-1]) + 1) * width
            out[low:high] += np.bincount(flat - low, minlength=high - low)

    rows, pieces, size, pad = [], [], 0, np.full(2, 32, np.uint32)
    for i, text in enumerate(texts):
        codes = _codes(text or "")
        if not (codes != 32).any():  # no letter
            continue
        codes = np.concatenate([pad, codes])
        for at in range(2, len(codes), PIECE):
            rows.append(i), pieces.append(codes[at - 2:at + PIECE])
            size += len(pieces[-1])
            if size >= PIECE:
                count(rows, pieces)
                rows, pieces, size = [], [], 0
    if rows:
        count(rows, pieces)
    return out.reshape(len(texts), width)


def damped(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of unit rows; starts with rows far from each other."""
    centres = [unit(x.mean(axis=0))]
    while len(centres) < min(k, len(x)):
        centres.append(x[np.argmin((x @ np.array(centres).T).max(axis=1))])
    c = np.array(centres)
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.array([unit(x[near == i].mean(axis=0)) if (near == i).any() else c[i] for i in range(len(c))])
    return c


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]       # of each centroid
    least: list[float]     # of each centroid: the least cosine of a long text that isn't rejected

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text."""
        counts = ngram_counts(texts)
        empty = counts.sum(axis=1) == 0
        if not len(self.langs):
            return [(UNKNOWN, 0.0, True)] * len(texts)
        cosines = unit(damped(counts) * self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        full = np.sqrt(np.minimum(1, (counts > 0).sum(axis=1) / FULL_GRAMS))
        out = []
        for i, b in enumerate(best.tolist()):
            score = min(1.0, max(0.0, float(cosines[i, b])))
            out.append((UNKNOWN, 0.0, True) if empty[i] else (self.langs[b], score, bool(score < self.least[b] * full[i])))
        return out


def held_out() -> Column:
    """Documents that the model never learns from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, fit_rows: int = FIT_ROWS, clusters: int = CLUSTERS) -> Model:
    """Learn from (text, lang) of ``docs``.

    One pass over all texts counts the documents of each n-gram bucket and passes
    on the vectors of a sample (``fit_rows`` a language, twice that at most), on
    which the centroids are clustered. Rows with a null lang or without a letter
    are left out; without any row the model knows no language.
    """
    text_batches(docs.sparkSession)
    known = docs.where("lang is not null").select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    rates = {lang: min(1.0, 1.5 * fit_rows / n) for lang, n in sizes.items()}
    width = 1 << BUCKET_BITS
    ddl = "lang string, u double, at array<int>, value array<double>"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(width + 1)
        for batch in slices(batches, 64):
            counts = ngram_counts(batch.column(0).to_pylist())
            full = counts.any(axis=1)
            seen += np.append((counts > 0).sum(axis=0), full.sum())
            langs, u = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rows = [(langs[i], u[i], np.flatnonzero(counts[i]), counts[i][counts[i] > 0]) for i in np.flatnonzero(full) if u[i] < rates[langs[i]]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((None, None, at, seen[at]), schema)], schema=schema)

    u = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    rows = table(known.select("text", "lang", u.alias("u")).mapInArrow(run, ddl), "grams")
    seen = np.zeros(width + 1)
    pairs = F.explode(F.arrays_zip("at", "value")).alias("p")
    for r in rows.where("lang is null").select(pairs).groupBy("p.at").agg(F.sum("p.value").alias("n")).collect():
        seen[r["at"]] = r["n"]
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1
    sample = sorted(rows.where("lang is not null").collect(), key=lambda r: (r["lang"], r["u"], len(r["at"])))
    drop(rows)
    centroids, langs, least = [], [], []
    for lang in sorted({r["lang"] for r in sample}):
        mine = [r for r in sample if r["lang"] == lang][:2 * fit_rows]
        x = np.zeros((len(mine), width))
        for i, r in enumerate(mine):
            x[i, r["at"]] = damped(np.array(r["value"]))
        x = unit(x * idf)
        found = kmeans(x, clusters)
        long = [i for i, r in enumerate(mine) if len(r["at"]) >= FULL_GRAMS] or range(len(mine))
        low = REJECT_SHARE * float(np.quantile((x[long] @ found.T).max(axis=1), REJECT_QUANTILE))
        centroids += list(found)
        langs += [lang] * len(found)
        least += [low] * len(found)
    return Model(idf.astype(np.float32), np.array(centroids, np.float32).reshape(-1, width), langs, least)


def predictor(model: Model):
    """Column function: text -> struct(lang, score, rejected)."""

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        values = [t if isinstance(t, str) else None for t in texts]
        rows = [r for at in range(0, len(values), 64) for r in model.predict(values[at:at + 64])]
        return pd.DataFrame(rows, columns=["lang", "score", "rejected"])

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of each whole text. ``und``, score 0 and
    rejected: a text that is null or has no letter. ``rejected`` is also true of a
    text whose cosine with the nearest centroid is below that language's least for a
    text of its size."""
    found = docs.select("doc_id", predictor(model)(F.col("text").cast("string")).alias("p"))
    return found.select("doc_id", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out()))
    found = identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def known_language(docs: DataFrame) -> DataFrame:
    """``docs`` whose language is recognised, with that language as ``lang``."""
    model = train(docs)
    row = docs.select(F.struct("*").alias("row"), predictor(model)(F.col("text").cast("string")).alias("p"))
    lang = dict(docs.dtypes)["lang"]
    return row.where("not p.rejected").select(
        *[F.col("p.lang").cast(lang).alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])
