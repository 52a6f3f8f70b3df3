"""Landed system tables.

System tables are landed as Parquet (one dataset per table) or registered in
the catalog. A ``TableSet`` is a lazy name -> DataFrame map over a folder;
nothing is read until a query needs it, and column pruning / filter pushdown
reach each scan.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


class TableSet(Mapping[str, DataFrame]):
    """Lazy map of table name -> DataFrame over ``{root}/{name}.parquet`` (or
    ``{root}/{name}`` folders). Extra frames (derived tables) can be added."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", suffix: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.suffix = suffix
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        """``{root}/{name}{suffix}``; without a suffix a local ``{name}.{fmt}``
        file is used when present, else the ``{name}`` dataset folder."""
        if self.suffix is not None:
            return f"{self.root}/{name}{self.suffix}"
        single = f"{self.root}/{name}.{self.fmt}"
        if "://" not in self.root and os.path.exists(single):
            return single
        return f"{self.root}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.format(self.fmt).load(self.path(name))
        return self._cache[name]

    def add(self, name: str, df: DataFrame) -> None:
        self._cache[name] = df

    def __iter__(self) -> Iterator[str]:
        return iter(self._cache)

    def __len__(self) -> int:
        return len(self._cache)


def scan(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """``SELECT *`` of a landed system table."""
    return tables[name]


def scan_capped(spark: SparkSession, fqn_or_df, n: int | None = None) -> DataFrame:
    """S4 + L1: a caller-named history table, whole.

    The source caps it (``LIMIT``, no order: which rows stay is arbitrary). A cap
    applies here only if the caller gives ``n``; that is logged, as it may drop
    rows, and sends those kept through one task."""
    df = spark.table(fqn_or_df) if isinstance(fqn_or_df, str) else fqn_or_df
    if n is None:
        return df
    log.warning("history capped at %d rows: rows beyond are not exported", n)
    return df.limit(n)
