"""Export writers (K1-K5, K7).

Every export is written by the executors straight to the output folder; no
rows pass through the driver. Row counts come from ``DataFrame.observe``
(collected by the write job itself, no second pass).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import logging
import os
import threading
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.functions.normalize import hour_label, iso_text_columns, normalize_for_export, require_utc
from whlens.operators.nested import nested_to_json
from whlens.operators.windows import parse_day

log = logging.getLogger(__name__)

ON_EMPTY = ("schema", "skip")


def export_path(out_dir: str, engine: str, name: str, **params) -> str:
    """K7: ``{out}/{engine}-logs/{name}`` with ``{schema}``/``{catalog}``
    placeholders of the name filled from ``params``."""
    return os.path.join(out_dir, f"{engine}-logs", name.format(**params))


_HELD: dict[tuple[str, str], list] = {}     # (key, value): writers inside, the value before
_LOCK = threading.Lock()


@contextlib.contextmanager
def _conf(spark, key: str, value: str):
    """A session setting for the time of a write. Writers side by side share it: the first
    sets it, the last puts back what was there."""
    with _LOCK:
        held = _HELD.setdefault((key, value), [0, spark.conf.get(key, None)])
        held[0] += 1
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _LOCK:
            held[0] -= 1
            if not held[0]:
                del _HELD[key, value]
                if held[1] is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, held[1])


def _remove(spark, path: str) -> None:
    """Delete a dataset that holds no rows, wherever the path lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _partitions(spark, path: str, label: str) -> list[str]:
    """Values of ``label`` that have a folder under ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return [n.removeprefix(f"{label}=") for n in names if n.startswith(f"{label}=")]


def write_export(df: DataFrame, path: str, normalize: bool = True, json_nested: bool = False,
                 on_empty: str = "schema", mode: str = "overwrite", fmt: str = "parquet",
                 partition_by: list[str] | None = None, max_records_per_file: int = 0) -> int | None:
    """K1/K2/K5: write ``df`` as a dataset at ``path`` and return its row count.

    * ``normalize``: zoned times to UTC wall time, times rounded half-even to
      the millisecond (N1, N2); Parquet stores them as UTC instants in
      milliseconds (K2: it has that unit for zoned times only);
    * ``json_nested``: struct / array / map columns as JSON text (N3);
    * ``on_empty="skip"`` leaves nothing at ``path`` for an empty result, nor a
      dataset of an earlier run (returns None); ``"schema"`` leaves a
      schema-only dataset. The write's own row count decides; the plan runs once;
    * ``partition_by``: folders by these columns; only those of ``df``'s own values are
      replaced, and ``on_empty`` has no meaning: without rows nothing changes.
    """
    if on_empty not in ON_EMPTY:
        raise ValueError(f"on_empty must be one of {ON_EMPTY}")
    if json_nested:
        df = nested_to_json(df)
    if normalize:
        df = normalize_for_export(df)
    if fmt == "parquet":
        zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
        if zoneless:
            require_utc(df)
            df = df.withColumns({c: F.col(f"`{c}`").cast("timestamp") for c in zoneless})
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", "true")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with _conf(df.sparkSession, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MILLIS"):
        writer.save(path)
    rows = obs.get.get("rows", 0)
    if not rows and on_empty == "skip" and not partition_by:
        if mode == "overwrite":
            _remove(df.sparkSession, path)
        log.info("no rows for %s: nothing written", path)
        return None
    log.info("wrote %s rows to %s", rows, path)
    return rows


HOURS = "_hours"    # a hidden folder: readers of the export don't see it


def hours_of(start, end) -> list[str]:
    """The hour labels of a window of whole days, both included."""
    first, last = parse_day(start), parse_day(end)
    at = dt.datetime(first.year, first.month, first.day)
    n = ((last - first).days + 1) * 24
    return [(at + dt.timedelta(hours=i)).strftime("%Y%m%d_%H") for i in range(max(0, n))]


def write_hourly(df: DataFrame, path: str, ts: str, label: str = "hour",
                 max_records_per_file: int = 5_000_000, window: tuple | None = None) -> int | None:
    """K3: one folder per hour (``hour=YYYYMMDD_HH``); hours without rows have none.

    A run replaces its own hours only: those of its rows, and of its ``window`` (first and
    last day) if given, where an hour that has no rows any more loses its folder. Hours of
    other runs stay. Every run adds the hours it is for to the ledger (``hourly_ledger``).
    Each hour is replaced as the write's job commits, so a run that fails before has
    changed nothing, and one that fails after can be run again.

    The rows are shuffled once with the ``REBALANCE(hour)`` hint: each hour
    goes to one task (one file per hour, as the source writes), small hours
    are coalesced, and AQE splits an hour that holds far more than the
    advisory partition size into several tasks / files, so a hot hour does
    not become one giant task. No sampling pass is needed (unlike a range
    partitioning). Timestamps are normalised as in K2 and nested columns
    written as JSON text. Returns the rows written, None without any."""
    spark = df.sparkSession
    df = normalize_for_export(nested_to_json(df))
    if label not in df.columns:
        df = df.withColumn(label, hour_label(F.col(ts)))
    balanced = df.hint("rebalance", label)
    run, started = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    hours = Observation()
    rows = write_export(balanced.observe(hours, F.collect_set(label).alias("hours")), path, normalize=False, partition_by=[label],
                        max_records_per_file=max_records_per_file)
    # Rows of each hour as its files have them: footers only.
    seen = {h: 0 for h in hours.get.get("hours") or []}
    if seen:
        written = spark.read.option("basePath", path).parquet(*[f"{path}/{label}={h}" for h in seen])
        seen = {r[label]: r["count"] for r in written.groupBy(label).count().collect()}
    mine = set(hours_of(*window)) if window else set()
    emptied = sorted(h for h in _partitions(spark, path, label) if h in mine and h not in seen)
    for hour in emptied:
        _remove(spark, f"{path}/{label}={hour}")
    ledger = [(run, started, h, seen.get(h, 0), "written" if h in seen else "emptied" if h in emptied else "none") for h in sorted(mine | set(seen))]
    if rows > sum(seen.values()):    # rows without a time
        ledger.append((run, started, None, rows - sum(seen.values()), "written"))
    if ledger:
        (spark.createDataFrame(ledger, "run string, started timestamp_ntz, hour string, rows long, action string").coalesce(1)
         .write.mode("append").parquet(f"{path}/{HOURS}"))
    return rows or None


def hourly_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(run, started, hour, rows, action) of every run that wrote to ``path``: written, emptied
    (the hour's folder went) or none (there was none). An hour's last run tells its rows."""
    return spark.read.parquet(f"{path}/{HOURS}")


def write_csv(df: DataFrame, path: str, on_empty: str = "skip") -> int | None:
    """K4: CSV with a header; timestamps as ISO text and missing values as
    empty strings (N5); nested columns as JSON text."""
    df = iso_text_columns(nested_to_json(df))
    return write_export(df, path, normalize=False, on_empty=on_empty, fmt="csv")
