"""The named exports of every warehouse and the runner (section 2.13, K6).

An ``ExportSpec`` builds one lazy DataFrame from the landed system tables
(a name -> DataFrame mapping, see ``whlens.sources.files.TableSet``) and
says how it is written. ``run_exports`` writes the exports of one warehouse,
a few at a time; a failing export is recorded and the others go on.

Landed table names follow the warehouse's own names (``billing.usage``,
``compute.warehouses``, ``TABLES``, ``stl_query``, ``sys.partitions``, ...);
each builder below names the tables it reads.
"""

from __future__ import annotations

import dataclasses
import logging
import os
import threading
from collections.abc import Callable, Mapping

from pyspark import InheritableThread
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from whlens.operators import catalog as cat
from whlens.operators import text as txt
from whlens.plans import athena, databricks as dbx, mssql, redshift, snowflake, starburst
from whlens.sinks.writers import export_path, write_csv, write_export, write_hourly
from whlens.operators.nested import tag
from whlens.operators.sizes import database_size, table_sizes
from whlens.operators.stats import analyze_schema
from whlens.sources.catalog import list_tables
from whlens.sources.json_pages import read_executions, read_history_pages

log = logging.getLogger(__name__)


@dataclasses.dataclass
class Params:
    """Run parameters (the source reads them from the environment)."""
    start: str | None = None                 # QUERY_LOG_START, YYYY-MM-DD
    end: str | None = None                   # QUERY_LOG_END, YYYY-MM-DD
    today: str | None = None                 # default current_date()
    open_end: str | None = None              # default current_timestamp()
    export_metadata: bool = False            # Databricks information_schema exports
    column_stats: bool = False               # Trino / Starburst stats export
    table_sizes: bool = False                # Trino / Starburst table and database sizes
    catalog: str | None = None
    schema: str | None = None
    stats_tables: Mapping[str, DataFrame] | None = None   # tables of ``schema``
    minmax_tables: Mapping[str, DataFrame] | None = None  # user tables for column_min_max
    history_cap: int | None = None           # the source's row cap; None exports everything
    history_table: str | None = None         # caller-named history table (Trino)
    stats_source: str = "scan"               # scan: one-pass profile | analyze: catalog statistics
    rest_pages: str | None = None            # folder of landed REST history pages
    executions_path: str | None = None       # folder of landed execution batches
    on_unreadable: str = "fail"              # landed JSON that is no page: fail | quarantine
    listing_pos: str | None = None           # Athena listing position column (early stop)
    athena_csv: bool = False                 # also write the CSV form
    # decisions on the source's quirks (README "Decisions and deviations")
    keep_unpriced: bool = False              # usage without a valid price kept (cost 0)
    latest_name: bool = False                # usage joined to the newest warehouse name only
    events_closed: str = "both"              # "left": an event on a change time matches one version
    ordered: bool = True                     # global order of usage / event exports
    schema_by_name: bool = False             # SQL Server row counts joined by table name only
    sum_partitions: bool = False             # SQL Server row counts summed over partitions
    ddl_rtrim: bool = True                   # trim chunk ends before joining DDL text


    @classmethod
    def from_env(cls, environ: Mapping[str, str] | None = None, **overrides) -> "Params":
        """Settings from the environment variables the source jobs read:
        ``QUERY_LOG_START`` / ``QUERY_LOG_END`` (YYYY-MM-DD), ``EXPORT_METADATA``
        and ``COLUMN_STATS`` (``true`` to enable), ``TRINO_CATALOG`` /
        ``TRINO_SCHEMA`` (or the ``STARBURST_`` ones) for catalog and schema."""
        env = dict(os.environ if environ is None else environ)

        def flag(name):
            return str(env.get(name, "")).strip().lower() == "true"
        p = cls(start=env.get("QUERY_LOG_START"), end=env.get("QUERY_LOG_END"),
                export_metadata=flag("EXPORT_METADATA"), column_stats=flag("COLUMN_STATS"),
                catalog=env.get("TRINO_CATALOG") or env.get("STARBURST_CATALOG"),
                schema=env.get("TRINO_SCHEMA") or env.get("STARBURST_SCHEMA"),
                history_table=env.get("TRINO_QH_TABLE"))
        return dataclasses.replace(p, **overrides)


Builder = Callable[[Mapping[str, DataFrame], Params], DataFrame | None]


@dataclasses.dataclass
class ExportSpec:
    engine: str
    name: str                                 # may hold {catalog} / {schema}
    build: Builder
    writer: str = "parquet"                   # parquet | hourly | csv
    on_empty: str = "schema"
    hourly_ts: str | None = None
    enabled: Callable[[Params], bool] = lambda p: True
    kind: str = "metadata"                    # metadata | query_logs


def _tables_as_text(df: DataFrame) -> DataFrame:
    """Databricks ``tables``: ``created`` / ``last_altered`` as text."""
    out = {c: F.col(c).cast("string") for c in ("created", "last_altered") if c in df.columns}
    return df.withColumns(out) if out else df


def _landed(tables: Mapping[str, DataFrame], name: str) -> bool:
    """Whether a table is there at all. One that is there but can't be read raises
    (here or when its export is written), so that the export fails rather than
    passing for one that doesn't apply."""
    try:
        tables[name]
        return True
    except KeyError:
        return False
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return False
        raise


def _schema_stats(tables: Mapping[str, DataFrame], p: Params) -> DataFrame | None:
    """Stats of the schema's tables: the given frames, else the tables the
    catalog lists for ``p.schema`` (S8). ``stats_source="analyze"`` reads
    catalog statistics after ``ANALYZE`` (A6) instead of profiling (A5)."""
    spark = _spark(tables)
    names = list(p.stats_tables) if p.stats_tables else list_tables(spark, p.schema)
    if p.stats_source == "analyze":
        return analyze_schema(spark, p.schema, names)
    frames = p.stats_tables or {n: spark.table(f"{p.schema}.{n}") for n in names}
    return starburst.stats(frames, p.schema)


def _trino_history(tables: Mapping[str, DataFrame], p: Params) -> DataFrame:
    h = _spark(tables).table(p.history_table) if p.history_table else tables["query_history"]
    return starburst.trino_history(h, p.history_cap)


def _user_table_min_max(t: Mapping[str, DataFrame], p: Params) -> DataFrame:
    """Min/max of the numeric columns that the catalog lists (J8), read from the landed
    user tables (``schema.table``) or from the given frames."""
    if p.minmax_tables:
        return mssql.column_min_max(p.minmax_tables)
    listed = cat.numeric_columns(t["sys.tables"], t["sys.schemas"], t["sys.columns"], t["sys.types"])
    of_table = (listed.groupBy("schema_name", "table_name").agg(F.array_sort(F.collect_set("column_name")).alias("columns"))
                .orderBy("schema_name", "table_name"))
    frames = [(r["table_name"], t[f"{r['schema_name']}.{r['table_name']}"].select(*[F.col(f"`{c}`") for c in r["columns"]]))
              for r in of_table.toLocalIterator()]      # a scan per table; they run in batches
    if not frames:
        raise ValueError("the catalog lists no numeric column")
    return mssql.column_min_max(frames)


def _sizes(tables: Mapping[str, DataFrame], p: Params) -> DataFrame:
    """Files, bytes and rows of the schema's tables, and of all of them together (table_name null)."""
    spark = _spark(tables)
    frames = p.stats_tables or {n: spark.table(f"{p.schema}.{n}") for n in list_tables(spark, p.schema)}
    each = table_sizes(spark, frames)
    whole = database_size(each).select(F.lit(None).cast("string").alias("table_name"), "files", "bytes", "row_count")
    return tag(each.unionByName(whole), schema_name=p.schema)


SPECS: list[ExportSpec] = [
    # --- Databricks -------------------------------------------------------------
    ExportSpec("databricks", "tables", lambda t, p: _tables_as_text(t["information_schema.tables"]),
               enabled=lambda p: p.export_metadata),
    ExportSpec("databricks", "columns", lambda t, p: t["information_schema.columns"],
               enabled=lambda p: p.export_metadata),
    ExportSpec("databricks", "views", lambda t, p: t["information_schema.views"],
               enabled=lambda p: p.export_metadata),
    ExportSpec("databricks", "usage", lambda t, p: dbx.usage_cost(
        t["billing.usage"], t["compute.warehouses"], t["billing.list_prices"], p.start, p.end, p.today,
        keep_unpriced=p.keep_unpriced, latest_name=p.latest_name, ordered=p.ordered)),
    ExportSpec("databricks", "event", lambda t, p: dbx.warehouse_events(
        t["compute.warehouse_events"], t["compute.warehouses"], p.start, p.end, p.open_end,
        closed=p.events_closed, ordered=p.ordered)),
    ExportSpec("databricks", "warehouse_info", lambda t, p: dbx.warehouse_info(t["compute.warehouses"])),
    ExportSpec("databricks", "query_history",
               lambda t, p: dbx.hourly_history(t["query.history"], p.start, p.end)
               if _landed(t, "query.history") else None,
               writer="hourly", hourly_ts="start_time", on_empty="skip", kind="query_logs"),
    ExportSpec("databricks", "query_history_output",
               lambda t, p: None if _landed(t, "query.history") else dbx.rest_history(
                   read_history_pages(_spark(t), p.rest_pages, on_unreadable=p.on_unreadable),
                   p.start, p.end),
               on_empty="skip", enabled=lambda p: p.rest_pages is not None, kind="query_logs"),
    # --- Snowflake ----------------------------------------------------------------
    ExportSpec("snowflake", "tables", lambda t, p: snowflake.live_tables(t["TABLES"], t["VIEWS"])),
    ExportSpec("snowflake", "views", lambda t, p: snowflake.live_objects(t["VIEWS"])),
    ExportSpec("snowflake", "columns", lambda t, p: snowflake.live_objects(t["COLUMNS"])),
    ExportSpec("snowflake", "functions", lambda t, p: snowflake.live_objects(t["FUNCTIONS"], "function_catalog")),
    ExportSpec("snowflake", "warehouse", lambda t, p: t["WAREHOUSES"]),
    ExportSpec("snowflake", "warehouse_usage", lambda t, p: snowflake.warehouse_usage(
        t["WAREHOUSE_METERING_HISTORY"], p.start, p.end)),
    ExportSpec("snowflake", "query_history_snowflake", lambda t, p: snowflake.query_history(
        t["QUERY_HISTORY"], p.start, p.end), on_empty="skip", kind="query_logs"),
    # --- Redshift -----------------------------------------------------------------
    ExportSpec("redshift", "types", lambda t, p: cat.rs_types(
        t["pg_type"], t["pg_namespace"], t["pg_class"], t["pg_description"], t["search_path"])),
    ExportSpec("redshift", "aggregates", lambda t, p: cat.rs_aggregates(
        t["pg_proc"], t["pg_namespace"], t["pg_type"], t["pg_description"], t["search_path"])),
    ExportSpec("redshift", "casts", lambda t, p: cat.rs_casts(
        t["pg_cast"], t["pg_proc"], t["pg_type"], t["pg_namespace"], t["search_path"])),
    ExportSpec("redshift", "columns", lambda t, p: t["information_schema.columns"]),
    ExportSpec("redshift", "table_def", lambda t, p: t["pg_table_def"]),
    ExportSpec("redshift", "views", lambda t, p: t["pg_views"]),
    ExportSpec("redshift", "user", lambda t, p: t["pg_user"]),
    ExportSpec("redshift", "query_text", lambda t, p: txt.query_text(
        t["stl_query"], t["stl_querytext"], p.start, p.end), kind="query_logs"),
    ExportSpec("redshift", "query_ddl", lambda t, p: txt.ddl_text(t["stl_ddltext"], p.start, p.end,
                                                                  rtrim=p.ddl_rtrim), kind="query_logs"),
    ExportSpec("redshift", "query_metrics", lambda t, p: redshift.query_metrics(
        t["stl_query_metrics"], p.start, p.end), kind="query_logs"),
    ExportSpec("redshift", "query_queue_info", lambda t, p: redshift.query_queue_info(
        t["svl_query_queue_info"], p.start, p.end), kind="query_logs"),
    ExportSpec("redshift", "query_wlm", lambda t, p: redshift.query_wlm(t["stl_wlm_query"], p.start, p.end),
               kind="query_logs"),
    # --- SQL Server ---------------------------------------------------------------
    ExportSpec("mssql", "schema", lambda t, p: cat.table_schema(
        t["information_schema.tables"], t["information_schema.columns"], t["sys.tables"], t["sys.partitions"],
        t["sys.schemas"], by_schema=not p.schema_by_name, sum_partitions=p.sum_partitions)),
    ExportSpec("mssql", "column_min_max", _user_table_min_max),
    ExportSpec("mssql", "query_history_mssql", lambda t, p: mssql.query_history(
        t["sys.dm_exec_query_stats"], t["sys.dm_exec_sql_text"], p.start, p.end), on_empty="skip", kind="query_logs"),
    # --- Trino --------------------------------------------------------------------
    ExportSpec("trino", "schema_info_{catalog}", lambda t, p: starburst.schema_info(
        t["information_schema.columns"], p.catalog)),
    ExportSpec("trino", "stats_{schema}", _schema_stats, enabled=lambda p: p.column_stats),
    ExportSpec("trino", "sizes_{schema}", _sizes, enabled=lambda p: p.table_sizes),
    ExportSpec("trino", "query_history_trino", _trino_history, on_empty="skip", kind="query_logs"),
    # --- Starburst ----------------------------------------------------------------
    ExportSpec("starburst", "schema_info_{catalog}", lambda t, p: starburst.schema_info(
        t["information_schema.columns"], p.catalog)),
    ExportSpec("starburst", "stats_{schema}", _schema_stats, enabled=lambda p: p.column_stats),
    ExportSpec("starburst", "sizes_{schema}", _sizes, enabled=lambda p: p.table_sizes),
    ExportSpec("starburst", "query_history_starburst", lambda t, p: starburst.query_history(
        t["query_history"], p.start, p.end), on_empty="skip", kind="query_logs"),
    # --- Athena -------------------------------------------------------------------
    ExportSpec("athena", "athena_query_logs", lambda t, p: athena.query_logs(
        read_executions(_spark(t), p.executions_path, on_unreadable=p.on_unreadable) if p.executions_path else t["executions"],
        p.start, p.end, p.listing_pos), on_empty="skip", kind="query_logs"),
    ExportSpec("athena", "athena_query_logs.csv", lambda t, p: athena.query_logs(
        read_executions(_spark(t), p.executions_path, on_unreadable=p.on_unreadable) if p.executions_path else t["executions"],
        p.start, p.end, p.listing_pos), writer="csv", on_empty="skip", enabled=lambda p: p.athena_csv,
        kind="query_logs"),
]


def _spark(tables: Mapping[str, DataFrame]) -> SparkSession:
    spark = getattr(tables, "spark", None)
    return spark if spark is not None else SparkSession.getActiveSession()


def specs_for(engine: str) -> list[ExportSpec]:
    return [s for s in SPECS if s.engine == engine]


STATUS_SCHEMA = "export string, path string, status string, rows long, error string"


KINDS = ("metadata", "query_logs")
#: Exports that run side by side.
PARALLEL = 4


def _run_export(spec: ExportSpec, tables: Mapping[str, DataFrame], out_dir: str, params: Params) -> tuple:
    """One export's status row; whatever goes wrong is in it."""
    name = spec.name.format(catalog=params.catalog, schema=params.schema)
    path = export_path(out_dir, spec.engine, name)
    if not spec.enabled(params):
        return name, path, "disabled", None, None
    try:
        df = spec.build(tables, params)
        if df is None:
            return name, path, "not_applicable", None, None
        if spec.writer == "hourly":
            rows = write_hourly(df, path, spec.hourly_ts, window=(params.start, params.end) if params.start and params.end else None)
        elif spec.writer == "csv":
            rows = write_csv(df, path, spec.on_empty)
        else:
            rows = write_export(df, path, json_nested=True, on_empty=spec.on_empty)
        return name, path, "written" if rows is not None else "empty", rows, None
    except Exception as exc:  # noqa: BLE001 - isolation: record and continue
        log.error("export %s failed: %s", name, exc)
        return name, path, "failed", None, str(exc)[:2000]


def run_exports(spark: SparkSession, engine: str, tables: Mapping[str, DataFrame], out_dir: str,
                params: Params, only: list[str] | None = None,
                kinds: tuple[str, ...] = KINDS, parallel: int = PARALLEL) -> DataFrame:
    """K6: write every enabled export of ``engine`` of the given ``kinds``
    (metadata, query logs); one failure does not stop the others. Returns one
    status row per export (written / empty / disabled / not applicable /
    failed, rows, error text), in the order of the specs.

    Up to ``parallel`` exports run side by side, each in a pool of its own: under the FAIR
    scheduler (``build_session`` asks for it) the many short catalog exports don't wait
    for the tasks of a long history export."""
    specs = [s for s in specs_for(engine) if (not only or s.name in only) and s.kind in kinds]
    status: dict[int, tuple] = {}
    waiting = iter(enumerate(specs))
    lock = threading.Lock()

    def work() -> None:
        while True:
            with lock:
                i, spec = next(waiting, (None, None))
            if spec is None:
                return
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{engine}-{i}")
            status[i] = _run_export(spec, tables, out_dir, params)
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    threads = [InheritableThread(target=work, session=spark) for _ in range(max(1, min(parallel, len(specs))))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return spark.createDataFrame([status[i] for i in sorted(status)], STATUS_SCHEMA)
