"""Conversation structure repair by lightest derivations.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. An item says
that the rows so far can be turned into a legal beginning that ends in a state of this
grammar; an edit of the next row (or an inserted turn) and an item give another one.
The weight of an item is (cost, audit), audit being the edits' initials. Such a weight
never falls by more edits, and of two derivations of an item the lighter stays the
lighter whatever follows (equal costs mean audits of which none begins the other), so
Knuth's agenda is exact: the lightest open item is final, until the goal is.

Rows are sorted once by range, without their texts. A task runs the agenda for a block
of ``2 ** BLOCK_BITS`` rows of a conversation from each state; blocks meet in rounds of
deductions with two premises, so no conversation needs to fit in one task before its
audit, one value of the result, is put together. Texts follow in a second sort and pass
through tasks row by row.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from whlens.llm.common import arrow_schema, drop, partitions, slices, table, text_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after the system's turn, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE = {"u": "user", "a": "assistant"}
#: The one role that may be inserted or given in a state.
TURN = {q: role for (q, role) in NEXT if role in ROLE}
GOALS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}

BLOCK_BITS, MERGE_BITS = 8, 6
SPACES = " \t\n\x0b\x0c\r"
#: Known results a task keeps.
MEMO = 20_000

SUMMARY = "conv_id long, block long, first string, last string, illegal long, costs array<long>, audits array<string>"


def edits(symbol: str) -> list[tuple[int, str, str | None]]:
    """(cost, letter, role) for a row: its role's initial, then x (must go), t (truncated)
    or k. A role of None is whatever the state asks for, "" is no turn at all."""
    initial, fault = symbol
    found = [(DELETE, "D", "")]
    if fault != "x":
        more = TRUNCATED if fault == "t" else 0
        found += [(KEEP + more, "K", initial), (REROLE + more, "R", None)]
    return found


def agenda(symbols: list[str], start: int, goals: tuple[int, ...] = ()) -> list[tuple[int, str] | None]:
    """Weight (cost, audit) of each state's item after all rows from ``start``, None where
    there is no derivation; with ``goals`` only until the first of them is final."""
    choices = [edits(s) for s in symbols]
    n = len(symbols)
    final: dict[tuple[int, int], tuple[int, str]] = {}
    open_items = [(0, "", 0, start)]
    known = {(0, start): (0, "")}
    while open_items:
        cost, audit, at, state = heapq.heappop(open_items)
        if (at, state) in final:
            continue
        final[at, state] = (cost, audit)
        if at == n and state in goals:
            break
        role = TURN[state]
        deduced = [(cost + INSERT, audit + "I", at, NEXT[state, role])]
        for more, letter, label in choices[at] if at < n else ():
            to = state if label == "" else NEXT.get((state, role if label is None else label))
            if to is not None:
                deduced.append((cost + more, audit + letter, at + 1, to))
        for item in deduced:
            key, weight = item[2:], item[:2]
            if key not in final and (key not in known or weight < known[key]):
                known[key] = weight
                heapq.heappush(open_items, item)
    return [final.get((n, q)) for q in range(4)]


def _illegal(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


def _block(symbols: str) -> tuple:
    """(first initial, last initial, illegal pairs, costs, audits) of a block; costs and
    audits by (state before, state after)."""
    rows = [symbols[i:i + 2] for i in range(0, len(symbols), 2)]
    weights = [w for start in range(4) for w in agenda(rows, start)]
    return (rows[0][0], rows[-1][0], _illegal(symbols[::2]), [w and w[0] for w in weights], [w and w[1] for w in weights])


def _join(left: tuple, right: tuple) -> tuple:
    """Two neighbouring blocks as one: the lightest pair of derivations by the state between."""
    costs, audits = [], []
    for a in range(4):
        for b in range(4):
            pairs = [(left[3][4 * a + m] + right[3][4 * m + b], left[4][4 * a + m] + right[4][4 * m + b])
                     for m in range(4) if left[3][4 * a + m] is not None and right[3][4 * m + b] is not None]
            best = min(pairs, default=(None, None))
            costs.append(best[0]), audits.append(best[1])
    return (left[0], right[1], left[2] + right[2] + (left[1] + right[0] not in LEGAL), costs, audits)


def _summaries(rows: list[tuple]) -> pa.RecordBatch:
    schema = arrow_schema(SUMMARY)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo: dict[str, tuple] = {}
    for batch in slices(batches):
        out = []
        for conv, block, symbols in zip(*(c.to_pylist() for c in batch.columns)):
            if symbols not in memo:
                if len(memo) >= MEMO:
                    memo.clear()
                memo[symbols] = _block(symbols)
            out.append((conv, block, *memo[symbols]))
        yield _summaries(out)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 16):
        out = []
        for conv, block, parts in zip(*(c.to_pylist() for c in batch.columns)):
            parts = [(p["first"], p["last"], p["illegal"], p["costs"], p["audits"]) for p in parts]
            while len(parts) > 1:
                parts = [_join(*parts[i:i + 2]) if len(parts) > i + 1 else parts[i] for i in range(0, len(parts), 2)]
            out.append((conv, block, *parts[0]))
        yield _summaries(out)


def _clean(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and a digest of the last two; nulls of these are one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def _ends(text: Column) -> Column:
    """The last character that is no white space; empty if there is none."""
    return F.right(F.rtrim(text, F.lit(SPACES)), F.lit(1))


def diagnose(turns: DataFrame) -> DataFrame:
    """Faults and lightest repair of each conversation of ``turns`` (conv_id long, turn
    long, role, text): (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit).

    Rows are taken by turn (nulls first), ties by role, then by a digest of the text;
    equal rows are told apart by nothing. A null role or text reads as one space; rows
    without a conv_id are one conversation. Texts of any length are read whole. No rows,
    no result. Columns beyond the four are ignored.
    """
    ends = _ends(F.col("text"))
    initial = F.substring("role", 1, 1)
    narrow = _clean(turns).select("conv_id", "turn", "role", "digest",
                                  F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
                                  F.when(ends == "", "b").when(~ends.isin(".", "!", "?"), "t").otherwise("k").alias("fault"),
                                  F.monotonically_increasing_id().alias("copy"))
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("copy")]
    # Where a hot conversation, turn or copy goes on, the range does: its rows split anywhere.
    ordered = table(narrow.repartitionByRange(partitions(turns.sparkSession), *keys).sortWithinPartitions(*keys)
                    .withColumn("at", F.monotonically_increasing_id()).drop("copy", "role"), "turns")
    first = ordered.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = ordered.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    rows = rows.withColumn("fault", F.when(F.col("fault") == "b", "b").when(F.col("at") > F.col("first"), "d").otherwise(F.col("fault")))
    rows = table(rows.select("conv_id", "turn", "initial", "fault", "at"), "faults")
    drop(ordered)

    counts = [F.count(F.when(F.col("fault") == f, 1)).alias(name) for f, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    report = table(rows.groupBy("conv_id").agg(gaps.alias("gaps"), *counts), "faults")

    # Blocks are numbered without holes, so that few rounds of merging suffice.
    bits = BLOCK_BITS
    inside = F.shiftright(F.col("at").bitwiseAND((1 << 33) - 1), bits)
    wide = (rows.agg(F.max(inside)).first()[0] or 0) + 1
    symbol = F.concat("initial", F.when(F.col("fault").isin("b", "d"), "x").otherwise(F.col("fault")))
    ordered_symbols = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", symbol.alias("s")))), lambda r: r["s"]), "")
    blocks = (rows.groupBy("conv_id", (F.shiftright("at", 33) * wide + inside).alias("block")).agg(ordered_symbols.alias("symbols"))
              .mapInArrow(_solve, SUMMARY))
    blocks, wanted = table(blocks, "blocks"), report.count()
    while blocks.count() > wanted:
        one = F.struct(F.col("block").alias("at"), "first", "last", "illegal", "costs", "audits")
        merged = (blocks.groupBy("conv_id", F.shiftright("block", MERGE_BITS).alias("to")).agg(F.array_sort(F.collect_list(one)).alias("parts"))
                  .mapInArrow(_merge, SUMMARY))
        before, blocks = blocks, table(merged, "blocks")
        drop(before)
    drop(rows)

    def goal(q: int) -> Column:
        return F.when(F.col("costs")[q].isNotNull(), F.struct(F.col("costs")[q].alias("cost"), F.col("audits")[q].alias("audit")))

    solved = blocks.select(F.col("conv_id").alias("c"), "illegal", F.least(*(goal(q) for q in GOALS)).alias("best"))
    out = report.join(solved, F.col("conv_id").eqNullSafe(F.col("c")))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit")


REPAIRED = "conv_id long, pos long, role string, text string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, the audit first, to the repaired turns."""
    schema = arrow_schema(REPAIRED)
    conv, audit, at, state, pos = None, "", 0, START, 0
    out: list[tuple] = []

    def turn(role: str, text: str, initial: str) -> None:
        nonlocal state, pos
        state = NEXT[state, initial]
        out.append((conv, pos, role, text))
        pos += 1

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            turn(ROLE[TURN[state]], "", TURN[state])
            at += 1

    def ready() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
        out.clear()
        return batch

    for batch in slices(batches):
        for key, its_audit, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if its_audit is not None:
                inserted()
                conv, audit, at, state, pos = key, its_audit, 0, START, 0
                continue
            inserted()
            edit = audit[at]
            at += 1
            if edit == "K":
                turn(role, text, role[0])
            elif edit == "R":
                turn(ROLE[TURN[state]], text, TURN[state])
        yield ready()
    inserted()
    yield ready()


def repaired(turns: DataFrame, diagnosis: DataFrame) -> DataFrame:
    """The turns (conv_id, pos, role, text) of ``turns`` after the edits of ``diagnosis``,
    whose ``diagnose`` result it is; each conversation's in order, in one partition."""
    text_batches(turns.sparkSession)
    rows = _clean(turns).select("conv_id", "turn", "role", "digest", "text", F.lit(None).cast("string").alias("audit"))
    heads = diagnosis.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
                             F.lit(None).cast("string").alias("text"), "audit")
    keys = ["conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "digest"]
    both = rows.unionByName(heads).repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions(*keys)
    return both.select("conv_id", "audit", "role", "text").mapInArrow(_apply, REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, digest = None, None
    done: list[tuple] = []

    def ready() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "sha256"])
        done.clear()
        return batch

    for batch in slices(batches):
        for conv, pos, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if not pos:
                if digest:
                    done.append((current, digest.hexdigest()))
                current, digest = conv, hashlib.sha256()
            digest.update(("\n" * (pos > 0) + role + ":" + text).encode())
        yield ready()
    if digest:
        done.append((current, digest.hexdigest()))
    yield ready()


def digests(repaired_turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, of ``repaired``'s result as it
    comes. A digest is made in order, so one task passes over a conversation's rows."""
    return repaired_turns.mapInArrow(_digests, "conv_id long, sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with the faults of op12's contract, by crc32 of ``conv_id:turn``."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    code = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("code")).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1))))
    return rows.drop("col")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = damaged(original)
    found = table(diagnose(turns), "repairs")
    hashes = digests(repaired(turns, found))
    every = original.select("conv_id").distinct()
    out = (every.alias("o").join(found.alias("f"), F.col("o.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
           .join(hashes.alias("h"), F.col("o.conv_id").eqNullSafe(F.col("h.conv_id")), "left"))
    zero = [F.coalesce(F.col(f"f.{c}"), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("o.conv_id", *zero, F.coalesce("f.audit", F.lit("")).alias("audit"),
                      F.coalesce("h.sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _sql_add(weight: str, cost: int | str, letter: str) -> str:
    """A weight is text, the cost in nine digits and the audit, so that the lesser text is the lighter."""
    return f"lpad((substr({weight}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({weight}, 10) || '{letter}'"


def _sql_insert(step: str) -> str:
    """A step that may insert one more turn in each state's item."""
    return f"""SELECT * REPLACE (
      least(w_u, {_sql_add('w_0', INSERT, 'I')}, {_sql_add('w_s', INSERT, 'I')}, {_sql_add('w_a', INSERT, 'I')}) AS w_u,
      least(w_a, {_sql_add('w_u', INSERT, 'I')}) AS w_a) FROM ({step})"""


def _sql_row() -> str:
    """One more row: each state's lightest item by deleting, keeping or reroling it."""
    more = f"CASE WHEN fault = 't' THEN {TRUNCATED} ELSE 0 END"
    states = {START: "w_0", SYSTEM: "w_s", USER: "w_u", ASSISTANT: "w_a"}
    columns = []
    for q, column in states.items():
        ways = [_sql_add(column, DELETE, "D")]
        for (before, label), after in NEXT.items():
            if after == q:
                ways.append(f"CASE WHEN fault <> 'x' AND initial = '{label}' THEN {_sql_add(states[before], more, 'K')} END")
                if label in ROLE:
                    ways.append(f"CASE WHEN fault <> 'x' THEN {_sql_add(states[before], f'{REROLE} + {more}', 'R')} END")
        columns.append(f"least({', '.join(ways)}) AS {column}")
    return f"""SELECT conv, n, k + 1 AS k, {', '.join(columns)}
      FROM (SELECT weighed.*, rows[k + 1].initial AS initial, rows[k + 1].fault AS fault FROM weighed JOIN lists USING (conv) WHERE k < weighed.n)"""


OP12_SQL = rf"""
WITH RECURSIVE shifted AS (
  SELECT i, i AS v, 0 AS step FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM shifted WHERE step < 8
), crc_table AS (SELECT list(v ORDER BY i) AS t FROM shifted WHERE step = 8
), coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 20 AS code
  FROM conversations, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM coded, (VALUES (1), (2)) copies(copy) WHERE code <> 0 AND (copy = 1 OR code = 3)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged
), marked AS (
  SELECT *, regexp_extract(text, '([^ 	-
])[ 	-
]*\z', 1) AS ends,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS seen,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM numbered
), judged AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN ends = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN ends NOT IN ('.', '!', '?') THEN 'truncated' END AS what FROM marked
), lists AS (
  SELECT row_number() OVER () AS conv, conv_id, count(*) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (what = 'blank') AS blank, count(*) FILTER (what = 'duplicate') AS duplicate, count(*) FILTER (what = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'initial': initial, 'fault': CASE what WHEN 'blank' THEN 'x' WHEN 'duplicate' THEN 'x' WHEN 'truncated' THEN 't' ELSE 'k' END, 'role': role, 'text': text}} ORDER BY pos) AS rows
  FROM judged GROUP BY conv_id
), weighed AS (
  {_sql_insert(_sql_insert("SELECT conv, n, 0::BIGINT AS k, '000000000' AS w_0, NULL::VARCHAR AS w_s, NULL::VARCHAR AS w_u, NULL::VARCHAR AS w_a FROM lists"))}
  UNION ALL
  {_sql_insert(_sql_insert(_sql_row()))}
), solved AS (
  SELECT conv, substr(least(w_0, w_a), 1, 9)::BIGINT AS cost, substr(least(w_0, w_a), 10) AS audit FROM weighed WHERE k = n
), walked AS (
  SELECT conv, audit, 0::BIGINT AS step, 0::BIGINT AS used, '' AS state, NULL::VARCHAR AS lines FROM solved
  UNION ALL
  SELECT conv, audit, step + 1, used + CASE WHEN edit = 'I' THEN 0 ELSE 1 END,
    CASE edit WHEN 'D' THEN state WHEN 'K' THEN r.initial ELSE asked END,
    CASE WHEN edit = 'D' THEN lines ELSE concat_ws(chr(10), lines,
      CASE edit WHEN 'K' THEN r.role ELSE CASE asked WHEN 'u' THEN 'user' ELSE 'assistant' END END || ':' || CASE edit WHEN 'I' THEN '' ELSE r.text END) END
  FROM (SELECT walked.*, substr(audit, step + 1, 1) AS edit, CASE state WHEN 'u' THEN 'a' ELSE 'u' END AS asked, rows[used + 1] AS r
    FROM walked JOIN lists USING (conv) WHERE step < length(audit))
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(w.audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN lists l ON o.conv_id IS NOT DISTINCT FROM l.conv_id
LEFT JOIN solved USING (conv) LEFT JOIN walked w ON w.conv = l.conv AND w.step = length(w.audit)
"""
