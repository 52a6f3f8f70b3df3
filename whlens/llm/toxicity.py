"""Toxic documents by a lexicon of learned terms, misspelled ones too.

Terms are words, or beginnings of words, that labelled toxic documents hold far more
often than others. They lie in a trie. Words run through the product of that trie with
the Levenshtein automata of its terms: a state is the set of (trie node, edits) still
possible, states are made when first reached and kept. So a word costs a look-up a
letter, most words end in the dead state after a few, and no term is compared by itself.
Each place a term is found at gets the probability that it is abuse and not quotation,
from the words in a window around it. What a term weighs with so many edits, the window's
words and the final logistic model are learned from the labelled documents.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from whlens.llm.common import drop, slices, table, text_batches

#: Labelled documents per class that a model is fitted on: the bounded sample, by a hash of their ids.
FIT_DOCS = 10_000
#: Terms and window words a model holds at most.
MAX_TERMS, MAX_CONTEXT = 5000, 2000
#: A term's odds between the classes (quotations lower them), and its G-squared against chance
#: (more, the more words and beginnings are tried).
MIN_ODDS, MIN_G2 = math.log(3), 18.0
MIN_STEM, MAX_STEM, MAX_WORD = 3, 12, 40
#: Words to either side that tell abuse from quotation.
WINDOW = 6
#: Known words and transitions a task keeps; then it starts anew.
MEMO = 200_000
PREDICT = 0.7

WORD = re.compile(r"[^\W_](?:[\w@$!*'’]*[^\W_])?")
#: Characters written for letters in disguised words.
DISGUISE = str.maketrans("013457@$!", "oieastasi")
RUN = re.compile(r"(.)\1{2,}")
ODD = re.compile(r"[013457@$!]|(.)\1\1")
QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“", "‘": "’", "`": "`"}
#: Words that report what others say, in the languages of the corpus.
REPORTING = frozenset("said says saying called calling quote quoted quotes wrote writes word words term so-called"
                      " dit disait appelé mot citation sagte sagt nannte wort zitat dijo dice llamó palabra cita".split())
ADDRESS = frozenset("you your you're u ur du dich dein deine tu te toi vous ton ta usted eres".split())
#: Log odds of abuse: without any cue, and of each cue before labelled documents speak.
BASE = 2.5
CUES = {"quoted": -1.5, "reported": -1.0, "addressed": 0.5}
#: Places in clean documents at which what is learned weighs as much as these.
CUE_PRIOR = 50


def allowed(term: str, stem: bool) -> int:
    """Edits at which a term is still found: none in short ones, fewer in stems."""
    if stem:
        return int(len(term) >= 6)
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Automaton:
    """Product of a trie of ``terms`` (text, whether a stem) with their Levenshtein automata."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most = [0]
        for i, (text, stem) in enumerate(terms):
            node, k = 0, allowed(text, stem)
            self.most[0] = max(self.most[0], k)
            for c in text:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({}), self.ends.append([]), self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], k)
            self.ends[node].append(i)
        self._clear()

    def _clear(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.found: list[tuple[dict[int, int] | None, dict[int, int] | None]] = []  # stems, words
        self.go: list[dict[str, int]] = []  # a state's transitions, as far as known
        self.moves = 0
        self.words: dict[str, tuple] = {}
        self._state({})
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, items: dict[int, int]) -> dict[int, int]:
        """With the states reached by leaving out letters of terms."""
        out, waiting = {}, sorted(items.items(), key=lambda x: x[1])
        for node, e in waiting:  # grows while it runs
            if e > self.most[node] or out.get(node, e + 1) <= e:
                continue
            out[node] = e
            if e < self.most[node]:
                waiting += [(c, e + 1) for c in self.child[node].values()]
        return out

    def _state(self, items: dict[int, int]) -> int:
        key = frozenset(items.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.go.append({})
            stems: dict[int, int] = {}
            words: dict[int, int] = {}
            for node, e in key:
                for t in self.ends[node]:
                    text, stem = self.terms[t]
                    if e <= allowed(text, stem):
                        kind = stems if stem else words
                        kind[t] = min(e, kind.get(t, e))
            self.found.append((stems or None, words or None))
        return self.number[key]

    def _next(self, state: int, letter: str) -> int:
        items: dict[int, int] = {}
        for node, e in self.states[state]:
            child = self.child[node]
            if e < self.most[node]:
                for to in child.values():
                    items[to] = min(e + 1, items.get(to, e + 1))
                items[node] = min(e + 1, items.get(node, e + 1))
            if letter in child:
                to = child[letter]
                items[to] = min(e, items.get(to, e))
        self.go[state][letter] = to = self._state(self._closed(items))
        self.moves += 1
        return to

    def _run(self, word: str) -> dict[int, int]:
        state, out, go, found = self.start, {}, self.go, self.found
        for letter in word:
            to = go[state].get(letter)
            state = self._next(state, letter) if to is None else to
            if not state:
                return out
            if found[state][0]:
                for t, e in found[state][0].items():
                    out[t] = min(e, out.get(t, e))
        for t, e in (found[state][1] or {}).items():
            out[t] = min(e, out.get(t, e))
        return out

    def match(self, word: str) -> tuple[tuple[int, int], ...]:
        """(term, edits) of the terms nearest to ``word``. Letters written as other
        characters or three times and more are one edit."""
        known = self.words.get(word)
        if known is not None:
            return known
        if len(self.words) >= MEMO or self.moves >= MEMO:
            self._clear()
        plain = word.lower()
        found = self._run(plain)
        if ODD.search(plain) and not plain.isdigit():
            for t, e in self._run(RUN.sub(r"\1", plain.translate(DISGUISE))).items():
                found[t] = min(e + 1, found.get(t, e + 1))
        least = min(found.values()) if found else 0
        self.words[word] = known = tuple(sorted((t, e) for t, e in found.items() if e == least)) if found else ()
        return known


@dataclass
class Model:
    """What ``train`` learns; ``prior`` is the score where it has learned nothing."""
    terms: list[tuple[str, bool]] = field(default_factory=list)
    weights: dict[tuple[int, int], float] = field(default_factory=dict)
    cues: dict[str, float] = field(default_factory=lambda: dict(CUES))
    context: dict[str, float] = field(default_factory=dict)
    coefficients: list[float] | None = None
    intercept: float = 0.0
    prior: float = 0.0


def _quotations(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of quoted passages of a paragraph's length."""
    starts, ends = [], []
    for m in re.finditer(r'"[^"\n]{1,400}"|“[^”\n]{1,400}”|«[^»\n]{1,400}»|„[^“\n]{1,400}“|(?<!\w)‘[^’\n]{1,400}’|`[^`\n]{1,400}`', text):
        starts.append(m.start()), ends.append(m.end())
    return starts, ends


def places(text: str, automaton: Automaton) -> list[tuple[int, int, tuple, list[str], list[str]]]:
    """(start, end, matches, cues, window) for each word of ``text`` near a term."""
    known, hit = automaton.words.get, {}
    for w in set(WORD.findall(text)):
        found = known(w)
        if found is None:
            found = automaton.match(w)
            known = automaton.words.get
        if found:
            hit[w] = found
    if not hit:
        return []
    words = list(WORD.finditer(text))
    lower = [w.group().lower() for w in words]
    starts, ends = _quotations(text)
    out = []
    for i, w in enumerate(words):
        if w.group() not in hit:
            continue
        before, after = lower[max(0, i - WINDOW):i], lower[i + 1:i + 1 + WINDOW]
        q = bisect_right(starts, w.start()) - 1
        cues = [name for name, there in (("quoted", q >= 0 and w.end() <= ends[q]), ("reported", not REPORTING.isdisjoint(before)),
                                         ("addressed", not ADDRESS.isdisjoint(before + after))) if there]
        out.append((w.start(), w.end(), hit[w.group()], cues, before + after))
    return out


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def evidence(text: str, automaton: Automaton, model: Model) -> tuple[list[float], list[tuple]]:
    """Features of a text, and its spans (start, end, term, edits, abuse)."""
    by_term: dict[int, float] = {}
    spans, abuses = [], 0.0
    for start, end, matches, cues, window in places(text, automaton):
        weight, t, e = max((model.weights.get((t, e), 0.0), t, e) for t, e in matches)
        if weight <= 0:
            continue
        abuse = _sigmoid(BASE + sum(model.cues[c] for c in cues) + sum(model.context.get(w, 0.0) for w in set(window)))
        by_term[t] = max(by_term.get(t, 0.0), abuse * weight)
        abuses += abuse
        spans.append((start, end, model.terms[t][0], e, abuse))
    if not spans:
        return [0.0] * 4, spans
    total = sum(by_term.values())
    return [math.log1p(total), max(by_term.values()), math.log1p(abuses), math.log1p(100 * total / (20 + len(text) / 6))], spans


# -- training ---------------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, fit_docs: int) -> DataFrame:
    """(text, toxic) of the documents with the ``fit_docs`` lowest hashed ids of each class.
    An id labelled more than once is toxic if any label says so."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("fit_id"))
             .agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    picked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("fit_id"), "fit_id").limit(fit_docs) for c in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    return docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["fit_id"]).select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), chosen["toxic"])


COUNTS = "key string, pos long, neg long"


def _counted(counts: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([v[i] for v in counts.values()], pa.int64()) for i in (0, 1))],
                                      names=["key", "pos", "neg"])


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by word (with a blank at its end) and by beginning of words."""
    for batch in slices(batches):
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            keys = set()
            for w in {w.lower() for w in set(WORD.findall(text))}:
                if MIN_STEM <= len(w) <= MAX_WORD and not w.isdigit():
                    keys.add(w + " ")
                    keys.update(w[:k] for k in range(MIN_STEM, min(len(w), MAX_STEM) + 1))
            for key in keys:
                counts.setdefault(key, [0, 0])[1 - toxic] += 1
        yield _counted(counts)


def _odds(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    return math.log((pos + 0.5) / (n_pos + 1)) - math.log((neg + 0.5) / (n_neg + 1))


def choose(counts: dict[str, tuple[int, int]], n_pos: int, n_neg: int) -> list[tuple[str, bool]]:
    """Terms among counted words and beginnings: of those that the same documents hold
    the longest, and none that adds little to a shorter one."""
    odds = {k: _odds(*c, n_pos, n_neg) for k, c in counts.items()}
    taken: dict[str, float] = {}
    longer = {k[:-1] for k, c in counts.items() if len(k) > MIN_STEM and counts.get(k[:-1]) == c}
    for key in sorted(counts, key=lambda k: (len(k.rstrip()), k)):
        shorter = [taken[key[:n]] for n in range(MIN_STEM, len(key)) if key[:n] in taken]
        if key not in longer and odds[key] > max(shorter, default=-math.inf) + (1 if shorter else 0):
            taken[key] = odds[key]
    return sorted((k.rstrip(), not k.endswith(" ")) for k in taken)


def _hits(batches: Iterator[pa.RecordBatch], terms: list[tuple[str, bool]]) -> Iterator[pa.RecordBatch]:
    """Documents by (term, edits); places by cue and by window word."""
    automaton = Automaton(terms)
    for batch in slices(batches):
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            seen, around = set(), Counter()
            for _, _, matches, cues, window in places(text, automaton):
                seen.update(f"t{t}:{e}" for t, e in matches)
                around.update([*(f"c{c}" for c in cues), *(f"w{w}" for w in set(window)), "n"])
            for key, n in [*((k, 1) for k in seen), *around.items()]:
                counts.setdefault(key, [0, 0])[1 - toxic] += n
        yield _counted(counts)


def _features(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    automaton = Automaton(model.terms)
    for batch in slices(batches):
        rows = [evidence(text, automaton, model)[0] for text in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1).cast(pa.int32())], names=["x", "toxic"])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """With a signature that near copies mostly share: the two least hashes of runs of five
    words. Copies would make terms of the words that only they have."""
    for batch in slices(batches):
        signatures = []
        for text in batch.column(0).to_pylist():
            words = text.split()
            least = heapq.nsmallest(2, {zlib.crc32(" ".join(words[i:i + 5]).encode()) for i in range(max(1, len(words) - 4))})
            signatures.append(least[0] << 31 ^ least[-1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), pa.array(signatures, pa.int64())], names=["text", "toxic", "signature"])


def _sums(df: DataFrame) -> DataFrame:
    return df.groupBy("key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """Learn from the texts of ``docs`` (doc_id long, text) whose ids ``labels`` (doc_id,
    toxic 0/1) marks; null labels and ids count for nothing. Of each class the documents of
    at most ``fit_docs`` ids are read, whole; of near copies one counts. Without both classes, or without a term that
    tells them apart, the model knows the share of toxic ids alone (0 without any; near copies once)."""
    spark = docs.sparkSession
    text_batches(spark)
    rows = _sample(docs, labels, fit_docs).mapInArrow(_signed, "text string, toxic int, signature long")
    rows = table(rows.dropDuplicates(["signature", "toxic"]).drop("signature").repartition(spark.sparkContext.defaultParallelism), "labelled")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    model = Model(prior=n_pos / (n_pos + n_neg) if n else 0.0)
    if n_pos and n_neg:
        _fit(rows, n_pos, n_neg, model)
    drop(rows)
    return model


def _fit(rows: DataFrame, n_pos: int, n_neg: int, model: Model) -> None:
    pos, neg, all_ = F.col("pos"), F.col("neg"), F.col("pos") + F.col("neg")
    xlogx = lambda c, of: F.when(c > 0, c * F.log(c / of)).otherwise(0.0)
    share = n_pos / (n_pos + n_neg)
    g2 = 2 * (xlogx(pos, all_ * share) + xlogx(neg, all_ * (1 - share)))
    odds = F.log((pos + 0.5) / (n_pos + 1)) - F.log((neg + 0.5) / (n_neg + 1))
    stems = table(_sums(rows.mapInArrow(_stems, COUNTS)), "stems")
    least = max(MIN_G2, 2 * math.log(max(1, stems.count())) - 4)    # less than one by chance is expected
    found = (stems.where((odds >= MIN_ODDS) & (g2 >= least))
             .orderBy(g2.desc(), F.length("key").desc(), "key").limit(20 * MAX_TERMS).collect())
    drop(stems)
    terms = choose({r["key"]: (r["pos"], r["neg"]) for r in found}, n_pos, n_neg)
    strength = {r["key"]: r["pos"] for r in found}
    model.terms = terms = sorted(sorted(terms, key=lambda t: (-strength[t[0] + " " * (not t[1])], t))[:MAX_TERMS])
    if not terms:
        return
    window = F.col("key").startswith("w")
    counted = table(_sums(rows.mapInArrow(lambda b: _hits(b, terms), COUNTS)), "hits")
    context = counted.where(window & (pos + neg >= 20)).orderBy((pos + neg).desc(), "key").limit(MAX_CONTEXT).collect()
    counts = {r["key"]: (r["pos"], r["neg"]) for r in counted.where(~window).collect()}
    drop(counted)
    for t in range(len(terms)):
        p0, q0 = counts.get(f"t{t}:0", (0, 0))
        prior = (p0 + 0.5) / (n_pos + 1), (q0 + 0.5) / (n_neg + 1)
        for e in range(allowed(*terms[t]) + 2):
            p, q = counts.get(f"t{t}:{e}", (0, 0))
            # A form never seen is as telling as the term, until it turns up in clean documents.
            odds = math.log((p + prior[0]) / (n_pos + 1)) - math.log((q + prior[1]) / (n_neg + 1))
            model.weights[t, e] = max(0.0, odds - 0.5 * e)
    on, off = counts.get("n", (0, 0))
    trust = off / (off + CUE_PRIOR)
    learned = lambda p, q: math.log((p + 1) / (on + 2)) - math.log((q + 1) / (off + 2))
    for cue, prior in CUES.items():
        model.cues[cue] = trust * max(-3.0, min(3.0, learned(*counts.get(f"c{cue}", (0, 0))))) + (1 - trust) * prior
    for r in context:
        model.context[r["key"][1:]] = trust * max(-0.5, min(0.5, learned(r["pos"], r["neg"])))
    fitted = table(rows.mapInArrow(lambda b: _features(b, model), "x array<double>, toxic int"), "features")
    known = LogisticRegression(featuresCol="v", labelCol="toxic", regParam=0.002, maxIter=60).fit(fitted.select(array_to_vector("x").alias("v"), "toxic"))
    drop(fitted)
    model.coefficients, model.intercept = [float(c) for c in known.coefficients], float(known.intercept)


# -- scoring ----------------------------------------------------------------------

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("term", pa.string()), ("edits", pa.int32()), ("abuse", pa.float64())]))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    automaton = Automaton(model.terms)
    for batch in slices(batches):
        scores, spans = [], []
        for text in batch.column(1).to_pylist():
            x, found = evidence(text or "", automaton, model) if model.coefficients else ([], [])
            scores.append(_sigmoid(model.intercept + sum(c * v for c, v in zip(model.coefficients, x))) if model.coefficients else model.prior)
            spans.append([dict(zip(("start", "end", "term", "edits", "abuse"), s)) for s in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, SPANS)], names=["doc_id", "score", "spans"])


def assess(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id long, score, spans) of every row of ``docs`` (doc_id, text): the probability
    that it is toxic, and the places of terms (start, end in code points, the term, its
    edits, the probability that it is abuse). Null and empty texts, and rows that repeat
    an id, are scored like any other; texts are read whole. Other columns are ignored."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _scored(b, model), "doc_id long, score double, spans array<struct<start:long,end:long,term:string,edits:int,abuse:double>>")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out)
    out = assess(docs, train(docs, labels))
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"),
                      F.size("spans").cast("long").alias("n_spans"))
