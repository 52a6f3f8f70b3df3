"""Conversation repair: the agenda against all edits, blocks, and the SQL."""

import binascii
import hashlib
import itertools
import random

import duckdb
from helpers import SF
from pyspark.sql import functions as F

from whlens.llm import repair as R

TURNS = "conv_id long, turn long, role string, text string"


def legal(initials):
    if initials == "":
        return True
    body = initials[1:] if initials[0] == "s" else initials
    return bool(body) and len(body) % 2 == 0 and body == "ua" * (len(body) // 2)


def brute(symbols):
    """Lightest (cost, audit) over all edits, with up to two inserted turns at each place."""
    best = None
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    ways = []
    for initial, fault in symbols:
        more = 5 if fault == "t" else 0
        own = [(2, "D", "")]
        if fault != "x":
            own += [(more, "K", initial), (1 + more, "R", "u"), (1 + more, "R", "a")]
        ways.append(own)
    for edits in itertools.product(*ways):
        for gaps in itertools.product(inserts, repeat=len(symbols) + 1):
            cost, audit, initials = 0, "", ""
            for i, gap in enumerate(gaps):
                cost, audit, initials = cost + 5 * len(gap), audit + "I" * len(gap), initials + "".join(gap)
                if i < len(edits):
                    cost, audit, initials = cost + edits[i][0], audit + edits[i][1], initials + edits[i][2]
            if legal(initials) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def lightest(symbols):
    return min(w for w in (R.agenda(symbols, R.START)[q] for q in R.GOALS) if w)


def test_agenda_against_all_edits():
    rng = random.Random(2)
    for n in (0, 1, 2, 3):
        for _ in range(12 if n == 3 else 40):
            symbols = [rng.choice("suua-") + rng.choice("kkktx") for _ in range(n)]
            assert lightest(symbols) == brute(symbols), symbols


def test_goal_is_final_first():
    rng = random.Random(4)
    for _ in range(300):
        symbols = [rng.choice("suuaa-") + rng.choice("kkktx") for _ in range(rng.randint(0, 12))]
        early = [w for q, w in enumerate(R.agenda(symbols, R.START, R.GOALS)) if w and q in R.GOALS]
        assert early == [lightest(symbols)]


def test_blocks_join_to_the_whole():
    rng = random.Random(6)
    for _ in range(200):
        symbols = [rng.choice("suuaa-") + rng.choice("kkktx") for _ in range(rng.randint(2, 40))]
        cuts = sorted(rng.sample(range(1, len(symbols)), min(len(symbols) - 1, rng.randint(1, 5))))
        parts = [R._block("".join(symbols[a:b])) for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        whole = R._block("".join(symbols))
        joined = parts[0]
        for p in parts[1:]:
            joined = R._join(joined, p)
        assert joined == whole


def reference(rows):
    """op12 for a list of rows, one conversation at a time."""
    out = []
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            code = binascii.crc32(key.encode()) % 20
            if code == 0:
                continue
            text = "" if code == 1 else "".join(x for x in text if x not in ".!?") if code == 2 else text
            kept += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns = [r[0] for r in kept if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, seen, symbols = dict.fromkeys("xdt", 0), set(), []
        for _, role, text in kept:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "x" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "k"
            seen.add((role, text))
            if fault in counts:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
            symbols.append(initial + ("x" if fault == "d" else fault))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit = lightest(symbols)
        lines, state, at = [], "", 0
        for edit in audit:
            asked = "a" if state == "u" else "u"
            if edit == "I":
                lines.append({"u": "user:", "a": "assistant:"}[asked])
                state = asked
                continue
            if edit == "K":
                lines.append(f"{kept[at][1]}:{kept[at][2]}")
                state = kept[at][1][0]
            elif edit == "R":
                lines.append({"u": "user:", "a": "assistant:"}[asked] + kept[at][2])
                state = asked
            at += 1
        out.append((conv, gaps, counts["x"], counts["d"], counts["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, tmp_out, rows, extra=()):
    df = spark.createDataFrame(rows, TURNS)
    for c in extra:
        df = df.withColumn(c, F.lit("x"))
    df.repartition(3).write.parquet(f"{tmp_out}/conversations.parquet")
    got = R.op12_repair(spark, tmp_out)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_query_against_sql_and_reference(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    got = sorted((tuple(r) for r in R.op12_repair(spark, SF).collect()), key=str)
    assert got == sorted(con.sql(R.OP12_SQL).fetchall(), key=str)
    assert got == reference([tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


def test_edge_rows(spark, tmp_out):
    long = "a word and more. " * 20_000
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, None, "Hello."), (1, 9, "assistant", None), (2, None, "user", "a."), (2, None, "user", "a."),
            (2, 3, "assistant", long), (2, 3, "assistant", long), (3, 5, "", "no role."), (None, 1, "user", "q?"), (None, None, "assistant", " "), (None, 2, "tool", "x"),
            (4, 1, "user", " \n"), (5, 7, "assistant", "end"), (6, 2**62, "user", "far."), (6, -5, "assistant", "before."), (None, None, None, None)]
    rows += [(100 + i, t, r, x) for i in range(40) for t, (r, x) in enumerate([("user", "Yes."), ("user", "No"), ("assistant", "Yes."), ("system", "!"), ("assistant", "")][: i % 6])]
    assert run(spark, tmp_out, rows, extra=("at", "fault", "c", "d", "first", "n", "block", "audit", "copy", "digest", "code", "col")) == reference(rows)


def test_one_conversation_over_many_blocks(spark, tmp_out):
    rng = random.Random(8)
    rows = [(7, i // 2, rng.choice(["user", "assistant", "assistant", "system", "tool"]), f"text {rng.randint(0, 1500)}" + rng.choice([".", "!", "", " "])) for i in range(3000)]
    rows += [(8, None, "user", "the same.")] * 700 + [(9, 1, "user", "short."), (9, 2, "assistant", "yes.")]
    assert run(spark, tmp_out, rows) == reference(rows)


def test_empty_table(spark, tmp_out):
    assert run(spark, tmp_out, []) == []


def test_all_rows_dropped(spark, tmp_out):
    conv = next(c for c in range(1000) if binascii.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, tmp_out, [(conv, 0, "user", "gone.")]) == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_are_legal(spark):
    turns = R.damaged(spark.read.parquet(f"{SF}/conversations.parquet"))
    found = R.diagnose(turns)
    for conv, initials in R.repaired(turns, found).groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "role"))), lambda r: F.substring(r["role"], 1, 1)), "")).collect():
        assert legal(initials), conv
