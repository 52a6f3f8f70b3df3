"""Personal data by weak supervision.

Patterns find candidate spans. Four labelers vote on each, for (1), against (-1) or
not at all (0): the strict form, a gazetteer, the words before, and a checksum or
the characters' entropy. Expectation-maximisation over the counted vote patterns
estimates each labeler's reliability without labels; its posteriors train the final
classifier of spans. Base spans (email, ip, card, phone that pass their checks) are
always kept; the classifier adds others.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from whlens.llm.common import arrow_schema, drop, slices, table, text_batches

# Kinds, patterns and word lists.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "handle", "iban", "secret", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])")
HANDLE = re.compile(r"(?<![A-Za-z0-9._%+@-])@[A-Za-z][A-Za-z0-9_]{2,29}(?![A-Za-z0-9_.@-])")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOP_DOMAINS = frozenset("com org net edu gov io info biz de fr es it uk eu us ca au jp cn in br nl se ch at".split())
SECRET_PREFIXES = ("ghp_", "gho_", "sk-", "pk-", "AKIA", "xox", "eyJ", "glpat-")
IBAN_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE".split())
CALLING_CODES = ("1", "7", "20", "27", "3", "4", "5", "6", "8", "9")
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write"), "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "call", "tel", "fax", "mobile"),
    "account": ("account", "acct", "konto", "cuenta", "compte", "customer"), "handle": ("follow", "twitter", "user", "by"),
    "iban": ("iban", "account", "bank"), "secret": ("token", "secret", "password", "passwd", "key", "apikey", "api_key", "bearer"),
    "ssn": ("ssn", "social", "security"),
}
#: Characters before a span that the context labeler reads.
BEFORE = 32
#: Spans the classifier is fitted on (chosen by a hash).
FIT_SPANS = 20_000
LABELERS = 4


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match of the e-mail pattern starts where the run of name characters before
    its @ starts, so only the surroundings of each @ are read."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds, by kind, then start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


INTERESTING = re.compile(r"[0-9@]")


def candidates(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and other spans that may be private, by kind, then start."""
    if not INTERESTING.search(text):
        return [], []
    base, more = base_spans(text), []
    taken = {(a, b) for _, a, b in base}
    more += [("account", m.start(), m.end()) for m in CARD.finditer(text) if 9 <= len(_digits(m.group())) <= 19]
    if "@" in text:
        more += [("handle", m.start(), m.end()) for m in HANDLE.finditer(text)]
    more += [("iban", m.start(), m.end()) for m in IBAN.finditer(text)]
    more += [("secret", m.start(), m.end()) for m in SECRET.finditer(text)]
    if "-" in text:
        more += [("ssn", m.start(), m.end()) for m in SSN.finditer(text)]
    return base, [s for s in more if (s[1], s[2]) not in taken]


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in (s.count(x) for x in set(s)))


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, int, int, int]:
    """What the labelers say: strict form, gazetteer, context, checksum or entropy."""
    s = text[start:end] if end - start <= 256 else text[start:start + 128] + text[end - 128:end]
    digits, before = _digits(s), text[max(0, start - BEFORE):start].lower()
    words = re.findall(r"[^\W\d][\w-]*", before)[-3:]
    context = 1 if any(w in CONTEXT[kind] for w in words) else 0 if kind in BASE_KINDS else -1
    if kind == "email":
        return 1, 1 if s.rpartition(".")[2].lower() in TOP_DOMAINS else -1, context, 1 if s[0].isalnum() else -1
    if kind == "ip":
        parts = s.split(".")
        return 1 if len(parts) == 4 else -1, -1 if parts[0] in ("0", "10", "127", "255") else 1, context, 0
    if kind == "card":
        return 1 if len(digits) == 16 else 0, 1 if digits[0] in "3456" else -1, context, 1
    if kind == "phone":
        return 1 if 10 <= len(digits) <= 13 else 0, 1 if digits.startswith(CALLING_CODES) else -1, context, 0
    if kind == "account":
        return -1 if "-" in s or " " in s else 0, 0, context, -1
    if kind == "handle":
        return 0, -1 if s[1:].lower() in ("media", "import", "param", "return", "override") else 0, context, 0
    if kind == "iban":
        moved = "".join(str(int(c, 36)) for c in s[4:] + s[:4])
        return 1 if 15 <= len(s) <= 34 else -1, 1 if s[:2] in IBAN_COUNTRIES else -1, context, 1 if int(moved) % 97 == 1 else -1
    if kind == "ssn":
        return 1 if s[:3] not in ("000", "666") and s[0] != "9" else -1, 0, context, 0
    known = s.startswith(SECRET_PREFIXES)
    mixed = any(c.isalpha() for c in s) and len(digits) >= 0.15 * len(s)  # unlike words joined by hyphens
    strict = mixed and (known or re.fullmatch(r"[0-9a-fA-F]{32,128}|[A-Za-z0-9]{20,256}", s))
    return 1 if strict else -1, 1 if known else 0, context, 1 if mixed and _entropy(s) > 3.2 else -1


FEATURES = 2 * LABELERS + 8


def features(kind: str, text: str, start: int, end: int, vote: tuple[int, ...]) -> list[float]:
    s, n = text[start:end][:256], max(1, min(256, end - start))
    share = lambda f: sum(map(f, s)) / n
    before, after = text[start - 1:start], text[end:end + 1]
    return [*(float(v > 0) for v in vote), *(float(v < 0) for v in vote), min(n, 64) / 64, share(str.isdigit), share(str.isupper),
            share(str.isalpha), _entropy(s) / 6 if s else 0.0, float(before in ('"', "'") and after == before and bool(before)),
            float(bool(re.search(r"[=:]\s*[\"']?$", text[max(0, start - 4):start]))), 1.0]


# Model.

def estimate(patterns: dict[tuple[str, tuple[int, ...]], float], rounds: int = 50) -> dict[tuple[str, tuple[int, ...]], float]:
    """Posterior of being private for each (kind, votes), by expectation-maximisation
    over their counts: a prior per kind, and for each labeler how often it votes
    -1, 0, 1 on private and on other spans. Starts with the votes' majority."""
    keys = sorted(patterns)
    if not keys:
        return {}
    count = np.array([patterns[k] for k in keys], float)
    vote = np.array([k[1] for k in keys]) + 1
    kind = np.array([KINDS.index(k[0]) for k in keys])
    p = 1 / (1 + np.exp(-2.0 * (vote - 1).sum(axis=1)))
    for _ in range(rounds):
        rate = np.empty((2, LABELERS, 3))
        for y, w in enumerate((count * (1 - p), count * p)):
            for j in range(LABELERS):
                rate[y, j] = [(w * (vote[:, j] == v)).sum() + 1 for v in range(3)]
        rate /= rate.sum(axis=2, keepdims=True)
        prior = np.array([((count * p)[kind == k].sum() + 1) / (count[kind == k].sum() + 2) for k in range(len(KINDS))])
        score = np.log(prior[kind]) - np.log(1 - prior[kind])
        for j in range(LABELERS):
            score += np.log(rate[1, j, vote[:, j]]) - np.log(rate[0, j, vote[:, j]])
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return dict(zip(keys, p.tolist()))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 25) -> np.ndarray:
    """Logistic regression with soft labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(x) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    weights: np.ndarray

    def private(self, x: np.ndarray) -> np.ndarray:
        return x.reshape(-1, FEATURES) @ self.weights >= 0

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        base, more = candidates(text or "")
        if more:
            keep = self.private(np.array([features(*c[:1], text, *c[1:], votes(c[0], text, *c[1:])) for c in more]))
            return base + [c for c, k in zip(more, keep) if k]
        return base


FOUND = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, more array<long>, "
         "vote array<long>, x array<double>, base_vote array<long>, base_x array<double>")


def span_table(docs: DataFrame) -> DataFrame:
    """One pass over all whole texts: base spans, other candidates (kind, start, end in
    ``more``), their votes and features, a row per document."""
    text_batches(docs.sparkSession)
    schema = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                base, more = candidates(text)
                voted = [[votes(*c[:1], text, *c[1:]) for c in group] for group in (base, more)]
                x = [[v for c, vote in zip(group, votes_of) for v in features(c[0], text, c[1], c[2], vote)]
                     for group, votes_of in zip((base, more), voted)]
                flat = [[KINDS.index(c[0]) * 81 + sum((v + 1) * 3 ** j for j, v in enumerate(vote)) for c, vote in zip(group, votes_of)]
                        for group, votes_of in zip((base, more), voted)]
                rows.append((key, *(sum(k == kind for k, _, _ in base) for kind in BASE_KINDS), ",".join(f"{k}:{a}:{b}" for k, a, b in base),
                             [v for k, a, b in more for v in (KINDS.index(k), a, b)], flat[1], x[1], flat[0], x[0]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, FOUND)


def train(found: DataFrame, fit_spans: int = FIT_SPANS) -> Model:
    """Labelers' reliabilities from the counted vote patterns of all spans (at most
    81 a kind), then the classifier from a sample of ``fit_spans`` spans and the
    posteriors of their votes. Without a span it adds nothing."""
    def spans(vote: str, x: str) -> DataFrame:
        part = lambda i: F.slice(x, i * FEATURES + 1, FEATURES)
        pairs = F.transform(vote, lambda v, i: F.struct(v.alias("vote"), part(i).alias("x")))
        return found.where(F.size(vote) > 0).select("doc_id", F.posexplode(pairs)).select("doc_id", "pos", "col.vote", "col.x")

    every = spans("vote", "x").union(spans("base_vote", "base_x"))
    code = lambda c: (KINDS[c // 81], tuple(c % 81 // 3 ** j % 3 - 1 for j in range(LABELERS)))
    counted = {code(r["vote"]): r["n"] for r in every.groupBy("vote").agg(F.count(F.lit(1)).alias("n")).collect()}
    posterior = estimate(counted)
    # A hash picks the sample before anything is sorted; the limit only takes off what it has too many.
    mark = F.xxhash64("doc_id", "pos", "vote")
    share = min(1.0, 1.1 * fit_spans / max(1, sum(counted.values())))
    chosen = every.where(F.pmod(mark, F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = chosen.orderBy(mark, "x").limit(fit_spans).collect()
    if not sample:
        return Model(np.array([*[0.0] * (FEATURES - 1), -1.0]))
    return Model(fit_logistic(np.array([r["x"] for r in sample]), np.array([posterior[code(r["vote"])] for r in sample])))


def find(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text (null: empty): doc_id, counts of the base
    kinds, ``base`` and ``spans`` as kind:start:end by kind, then start,
    comma-joined (code points, end exclusive). Rows of one doc_id are rows of
    their own; an empty table gives no rows."""
    found = table(span_table(docs), "spans")
    model = train(found)
    ddl = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for base, more, x in zip(*(batch.column(c).to_pylist() for c in ("base", "more", "x"))):
                keep = model.private(np.array(x))
                added = [f"{KINDS[more[3 * i]]}:{more[3 * i + 1]}:{more[3 * i + 2]}" for i in np.flatnonzero(keep)]
                out.append(",".join(filter(None, [base, *added])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(out, pa.string())], schema=schema)

    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "more", "x").mapInArrow(run, ddl)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """Each span becomes its kind in angle brackets; of overlapping spans the first counts for all."""
    if not spans:
        return text
    out, done, shown = [], 0, 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[shown:start], f"<{kind}>"]
        done = shown = max(done, end)
    return "".join([*out, text[shown:]])


def without_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced in ``text``, and ``n_chars`` to match."""
    found = table(span_table(docs), "spans")
    model = train(found)
    drop(found)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, model.spans(t)) if isinstance(t, str) else None for t in texts], dtype=object)

    row = docs.select(F.struct("*").alias("row"), cleaned(F.col("text").cast("string")).alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return row.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
