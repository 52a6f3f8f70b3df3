"""Catalog listings (S7, S8) and the probe-with-fallback source."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

CATALOG_COLUMNS = ("table_catalog", "table_schema", "table_name", "column_name",
                   "is_nullable", "data_type")


def catalog_columns(columns: DataFrame, catalog: str) -> DataFrame:
    """The six information-schema columns of one catalog."""
    return columns.select(*CATALOG_COLUMNS).where(F.col("table_catalog") == catalog)


def live_catalog_columns(spark: SparkSession, catalog: str | None = None,
                         databases: Sequence[str] | None = None) -> DataFrame:
    """S7 against the session catalog: the same six columns from
    ``spark.catalog`` (metadata only, one row per column)."""
    cat = catalog or spark.catalog.currentCatalog()
    dbs = databases or [d.name for d in spark.catalog.listDatabases()]
    rows = []
    for db in dbs:
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            for c in spark.catalog.listColumns(f"{db}.{t.name}"):
                rows.append((cat, db, t.name, c.name, "YES" if c.nullable else "NO", c.dataType))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CATALOG_COLUMNS))


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    """Names of the tables of a schema (catalog metadata)."""
    return [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]


def first_readable(readers: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """The first source whose one-row probe succeeds (``SELECT 1 ... LIMIT 1``).

    Each reader builds a DataFrame; it is probed with ``limit(1)`` (one row
    read at most). A failure (missing table, no access) moves on."""
    last = None
    for make in readers:
        try:
            df = make()
            df.select(F.lit(1)).limit(1).collect()
            return df
        except Exception as exc:  # noqa: BLE001 - any failure means "not readable"
            log.warning("source not readable, trying the next: %s", exc)
            last = exc
    raise RuntimeError("no readable source") from last
