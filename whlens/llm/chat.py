"""Conversations out of reply trees, in DataFrame functions only.

Self-joins that double their reach each time (a node's parent, then its ancestor at
distance 2, 4, ...) give each node its depth and score, and walk back from the chosen
leaves: a tree of depth n takes about log2(n) joins, and nothing grows faster than
the paths that are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from whlens.llm.common import table

# The template's marks, and other templates' control strings. None of
# them occurs in an escaped text.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"


# Text.

def escape(text: Column) -> Column:
    """Backslashes are doubled; a control string gets one after its first character."""
    marks = "|".join("(?<={})(?={})".format(_quoted(c[0]), _quoted(c[1:])) for c in CONTROL)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), marks, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|/" else c for c in s)


def _turn(role: Column, text: Column) -> Column:
    """One turn; line ends in a role are escaped too, as the first one ends it."""
    return F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"), escape(text), F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """array(struct(role, text)) of a formatted conversation, unescaped."""
    turns = F.filter(F.split(formatted, _quoted(END) + "\n"), lambda t: t != "")
    head = r"(?s)^" + _quoted(START) + r"((?:[^\\\n]++|\\.)*+)\n(.*)$"
    return F.transform(turns, lambda t: F.struct(
        unescape(F.regexp_extract(t, head, 1)).alias("role"), unescape(F.regexp_extract(t, head, 2)).alias("text")))


def masked(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


# Trees.

def jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Of ``nodes`` (conv_id, node, parent, score): for each k the table (conv_id,
    node, anc) of ancestors at distance 2**k; and every node's depth and total score
    from its root, without nodes that hang on a cycle. A parent that isn't there is
    as none."""
    known = nodes.select("conv_id", F.col("node").alias("parent"))
    start = (nodes.where("parent is not null").select("conv_id", "node", "parent", "score").join(known, ["conv_id", "parent"], "left_semi")
             .select("conv_id", "node", F.col("parent").alias("anc")))
    now = table(nodes.select("conv_id", "node", "score").join(start, ["conv_id", "node"], "left")
                .select("conv_id", "node", "anc", F.lit(1).cast("long").alias("depth"), F.col("score").alias("total")), "paths")
    n, levels, done = now.count(), [], []
    while True:
        done.append(now.where("anc is null"))
        live = now.where("anc is not null")
        # What still has an ancestor so far away as there are nodes hangs on a cycle.
        if live.isEmpty() or 1 << len(levels) > n:
            return levels, reduce(DataFrame.union, done).select("conv_id", "node", "depth", "total")
        levels.append(live.select("conv_id", "node", "anc"))
        above = reduce(DataFrame.union, [*done, live]).select("conv_id", F.col("node").alias("anc"), F.col("anc").alias("next"),
                                                              F.col("depth").alias("d"), F.col("total").alias("t"))
        now = table(live.join(above, ["conv_id", "anc"], "left").select(  # only those that haven't reached their root
            "conv_id", "node", F.col("next").alias("anc"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"),
            (F.col("total") + F.coalesce("t", F.lit(0.0))).alias("total")), "paths")


def _keyed(rows: DataFrame) -> DataFrame:
    """conv_id in a struct: that is never null, so joins match null conversations too."""
    return rows.withColumn("conv_id", F.struct("conv_id"))


def _unkeyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("conv_id", F.col("conv_id")["conv_id"])


def paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """(conv_id, path, pos, node): the nodes of each conversation's ``keep`` best
    root-to-leaf paths, numbered from 1 by mean score (ties: the longer path, then the
    smaller leaf); pos counts from 0 at the root. Null conv_ids are one conversation."""
    return _unkeyed(_paths(_keyed(nodes), keep))


def _paths(nodes: DataFrame, keep: int) -> DataFrame:
    levels, reached = jumps(nodes)
    parents = nodes.where("parent is not null").select("conv_id", F.col("parent").alias("node"))
    leaves = reached.join(parents, ["conv_id", "node"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy((F.col("total") / F.col("depth")).desc(), F.col("depth").desc(), "node"))
    found = leaves.withColumn("path", rank).where(F.col("path") <= keep).select("conv_id", "path", "node", (F.col("depth") - 1).alias("pos"))
    for k in reversed(range(len(levels))):  # each distance is a sum of powers of two: every ancestor comes up once
        here, there = F.struct("node", "pos"), F.struct(F.col("anc").alias("node"), (F.col("pos") - (1 << k)).alias("pos"))
        both = F.when(F.col("anc").isNull(), F.array(here)).otherwise(F.array(here, there))
        found = found.join(levels[k], ["conv_id", "node"], "left").select("conv_id", "path", F.explode(both).alias("n")).select("conv_id", "path", "n.node", "n.pos")
    return found


def format_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """Format reply trees ``nodes`` (conv_id, node, parent, role, text, score).

    Returns (conv_id, path, n_turns, formatted, loss) for each chosen path; loss has
    the (start, end) of the assistant's texts in ``formatted``, in code points.
    Null roles and texts are empty, null scores 0. Null conv_ids are one conversation.
    (conv_id, node) must be unique.
    Nodes on a cycle belong to no path. No rows, no result. A path's texts meet in
    one row, as they do in its output.
    """
    nodes = _keyed(nodes)
    ids = nodes.select("conv_id", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    texts = nodes.select("conv_id", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = _paths(ids, keep).join(texts, ["conv_id", "node"])
    turns = turns.select("conv_id", "path", "pos", "role", _turn(F.col("role"), F.col("text")).alias("turn"), F.length(_turn(F.col("role"), F.lit(""))).alias("bare"))
    end = F.sum(F.length("turn")).over(Window.partitionBy("conv_id", "path").orderBy("pos"))
    turns = turns.withColumn("end", (end - len(END) - 1).cast("int"))
    span = F.struct((F.col("end") - (F.length("turn") - F.col("bare"))).cast("int").alias("start"), "end")
    rows = F.sort_array(F.collect_list(F.struct("pos", "turn", F.when(F.col("role") == LOSS_ROLE, span).alias("span"))))
    out = _unkeyed(turns.groupBy("conv_id", "path").agg(rows.alias("rows")))
    return out.select("conv_id", "path", F.size("rows").cast("long").alias("n_turns"),
                      F.array_join(F.transform("rows", lambda r: r["turn"]), "").alias("formatted"),
                      F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss"))


def chains(conversations: DataFrame) -> DataFrame:
    """Reply trees of (conv_id, turn, role, text): each row answers the one before it,
    by turn (ties by role, then text). Rows without a conv_id are one conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return rows.select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], rows.schema)
    out = format_paths(chains(rows.unionByName(extra)))
    read = out.select("conv_id", parse(F.col("formatted")).alias("turns"), masked(F.col("formatted"), F.col("loss")).alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars")


def _sql_escape(column: str) -> str:
    out = rf"replace({column}, '\', '\\')"
    for c in CONTROL:
        out = rf"replace({out}, '{c}', '{c[0]}\{c[1:]}')"
    return out


OP5_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), learned AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LOSS_ROLE}'), '') AS learned,
    sum({len(START)} + length(replace({_sql_escape('role')}, chr(10), '\' || chr(10))) + 1 + length({_sql_escape('text')}) + {len(END) + 1}) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  formatted_chars::BIGINT AS formatted_chars
FROM learned
"""
