"""Row filters of the metadata and history exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def live_rows(df: DataFrame, deleted: str = "deleted", catalog: str = "table_catalog",
              excluded_catalogs: Sequence[str] = ("SNOWFLAKE",)) -> DataFrame:
    """F9 + F10: ``deleted IS NULL AND catalog NOT IN (...)``.

    ``NOT IN`` is three-valued: a null catalog is dropped, as in SQL."""
    return df.where(F.col(deleted).isNull() & ~F.col(catalog).isin(*excluded_catalogs))


def exclude_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """``col NOT IN (values)`` with SQL null semantics (null dropped)."""
    return df.where(~F.col(col).isin(*values))


def exclude_text(df: DataFrame, col: str, needles: Sequence[str]) -> DataFrame:
    """drop rows whose text contains any needle (literal, case-sensitive).

    Missing text counts as the empty string and is kept. ``contains`` is a
    plain substring test, so ``%``/``_`` in a needle are literal."""
    if not needles:
        return df
    text = F.coalesce(F.col(col), F.lit(""))
    hit = reduce(lambda a, b: a | b, [text.contains(n) for n in needles])
    return df.where(~hit)


def visible_objects(df: DataFrame, name_cols: Sequence[str], schema_col: str,
                    search_path: DataFrame, path_schema: str = "nspname",
                    path_rank: str = "rank_on_path", tie_breakers: Sequence[str] = ()) -> DataFrame:
    """F16: search-path visibility (``pg_type_is_visible`` and friends).

    An object is visible when its schema is on the path and no object with
    the same name (``name_cols``) sits in a schema earlier on the path.
    ``search_path`` is a (schema, rank) table of a few rows.
    The top-1 per name is a ``row_number() = 1`` that Spark plans with a
    partial ``WindowGroupLimit`` before the shuffle, so a popular name is
    cut to one row per map task before it moves. ``tie_breakers`` only
    matter when a schema holds two objects of one name (not possible in a
    real catalog)."""
    path = search_path.select(F.col(path_schema).alias("_vis_schema"), F.col(path_rank).alias("_vis_rank"))
    on_path = df.join(path, F.col(schema_col) == F.col("_vis_schema"), "inner")
    order = [F.col("_vis_rank").asc()] + [F.col(c).asc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*name_cols).orderBy(*order)
    return (on_path.withColumn("_vis_rn", F.row_number().over(w))
            .where(F.col("_vis_rn") == 1)
            .drop("_vis_rn", "_vis_schema", "_vis_rank"))
