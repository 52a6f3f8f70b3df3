"""Statement text exports: chunk joins and ordered reassembly.

Warehouses store long statements as fixed-size chunks (``sequence``, ``text``).
Reassembly is an ordered string aggregation per statement. It runs in two
levels: chunks are first concatenated per (statement, block of
``block_size`` sequence numbers) and the blocks are then concatenated per
statement. For ordinary statements the first level already yields one row;
for a statement with a huge number of chunks the sort/concatenation work is
spread over many tasks and only the final concatenation of block strings
(the output value itself) happens in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whlens.operators.windows import in_window

DEFAULT_BLOCK = 4096


def chunk_piece(text: str = "text", rtrim: bool = True):
    """``CASE WHEN LEN(RTRIM(t)) = 0 THEN t ELSE RTRIM(t) END`` (spaces only)."""
    t = F.col(text)
    if not rtrim:
        return t
    return F.when(F.length(F.rtrim(t)) == 0, t).otherwise(F.rtrim(t))


def _ordered_concat(value: str, order: str, sep: str = "") -> F.Column:
    # LISTAGG ... WITHIN GROUP (ORDER BY ...): nulls are skipped.
    return F.expr(f"listagg({value}, '{sep}') within group (order by {order})")


def reassemble_text(df: DataFrame, keys: Sequence[str], seq: str = "sequence",
                    text: str = "text", rtrim: bool = True, out: str = "sqltext",
                    attrs: dict[str, F.Column] | None = None,
                    block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """A3: one row per ``keys`` with the chunks concatenated in ``seq`` order.

    ``attrs`` are extra ``any_value``-style aggregates (name -> column) that
    are carried through both levels with ``any_value``."""
    attrs = attrs or {}
    staged = df.select(*[F.col(k) for k in keys],
                       F.col(seq).alias("_seq"),
                       chunk_piece(text, rtrim).alias("_piece"),
                       *[c.alias(f"_a_{n}") for n, c in attrs.items()])
    blocks = (staged.groupBy(*keys, F.floor(F.col("_seq") / F.lit(block_size)).alias("_blk"))
              .agg(_ordered_concat("_piece", "_seq").alias("_part"),
                   *[F.any_value(f"_a_{n}").alias(f"_a_{n}") for n in attrs]))
    return (blocks.groupBy(*keys)
            .agg(*[F.any_value(f"_a_{n}").alias(n) for n in attrs],
                 _ordered_concat("_part", "_blk").alias(out)))


def ddl_text(ddl: DataFrame, start=None, end=None, rtrim: bool = True,
             block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Export ``query_ddl``: DDL statements rebuilt from chunks.

    Window on ``starttime`` closed at both instants; group by (xid, pid);
    ``any_value`` of user, times and trimmed label (constant per statement)."""
    if start is not None:
        ddl = in_window(ddl, "starttime", start, end, "closed_instant")
    attrs = {}
    for name, expr in (("userid", F.col("userid")), ("starttime", F.col("starttime")),
                       ("endtime", F.col("endtime")), ("label", F.trim(F.col("label")))):
        if name in ddl.columns:
            attrs[name] = expr
    out = reassemble_text(ddl, ["xid", "pid"], "sequence", "text", rtrim, "sqltext",
                          attrs, block_size)
    lead = [c for c in ("userid", "starttime", "endtime", "label") if c in attrs]
    return out.select(*lead, "xid", "pid", "sqltext")


QUERY_TEXT_KEYS = ("userid", "xid", "pid", "query")
QUERY_TEXT_COLUMNS = ("userid", "xid", "pid", "query", "aborted", "concurrency_scaling_status",
                      "starttime", "endtime", "sequence", "text")


def query_text(queries: DataFrame, texts: DataFrame, start=None, end=None) -> DataFrame:
    """Export ``query_text``: query rows joined ``USING`` the 4 keys to their
    text chunks (one row per chunk), window closed on ``starttime``.

    The window filter is applied to the query side before the join. Both sides
    are facts, so neither gets a broadcast hint: AQE picks the join from the
    measured sizes and splits a skewed statement."""
    if start is not None:
        queries = in_window(queries, "starttime", start, end, "closed_instant")
    q_cols = [c for c in QUERY_TEXT_COLUMNS if c in queries.columns and c not in ("sequence", "text")]
    q = queries.select(*q_cols)
    t = texts.select(*QUERY_TEXT_KEYS, "sequence", "text")
    joined = t.join(q, list(QUERY_TEXT_KEYS), "inner")
    return joined.select(*[c for c in QUERY_TEXT_COLUMNS if c in joined.columns])


def apply_text(stats: DataFrame, texts: DataFrame, handle: str = "sql_handle",
               start=None, end=None, ts: str = "creation_time") -> DataFrame:
    """``CROSS APPLY sql_text(handle)`` as an inner equi-join; stats rows
    without text are dropped. Output: every stats column then the text
    columns (the handle once). Statement texts are as large as the history, so
    neither side gets a broadcast hint."""
    if start is not None:
        stats = in_window(stats, ts, start, end, "closed_instant")
    text_cols = [c for c in texts.columns if c != handle]
    t = texts.select(F.col(handle).alias("_h"), *text_cols)
    joined = stats.join(t, F.col(handle) == F.col("_h"), "inner")
    return joined.select(*stats.columns, *text_cols)
