"""Landed JSON responses of history APIs.

Pages are landed as JSON files, a response on each line or printed over many. ``ingest``
reads all of a folder (U3 append) and accounts for every file: its pages become VARIANT
records, what is no page is listed. An explicit schema makes an absent key read as null.
"""

from __future__ import annotations

import contextlib
import dataclasses
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from whlens.functions.normalize import require_utc
from whlens.session import shared_dir

# Metric fields of a history record and their types.
HISTORY_METRICS = [
    ("total_time_ms", T.LongType()),
    ("read_bytes", T.LongType()),
    ("rows_produced_count", T.LongType()),
    ("compilation_time_ms", T.LongType()),
    ("execution_time_ms", T.LongType()),
    ("read_remote_bytes", T.LongType()),
    ("write_remote_bytes", T.LongType()),
    ("read_cache_bytes", T.LongType()),
    ("spill_to_disk_bytes", T.LongType()),
    ("task_total_time_ms", T.LongType()),
    ("read_files_count", T.LongType()),
    ("read_partitions_count", T.LongType()),
    ("photon_total_time_ms", T.LongType()),
    ("rows_read_count", T.LongType()),
    ("result_fetch_time_ms", T.LongType()),
    ("network_sent_bytes", T.LongType()),
    ("result_from_cache", T.BooleanType()),
    ("pruned_bytes", T.LongType()),
    ("pruned_files_count", T.LongType()),
    ("provisioning_queue_start_timestamp", T.LongType()),
    ("overloading_queue_start_timestamp", T.LongType()),
    ("query_compilation_start_timestamp", T.LongType()),
]

HISTORY_RECORD = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("query_text", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("query_start_time_ms", T.LongType()),
    T.StructField("execution_end_time_ms", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField(n, t) for n, t in HISTORY_METRICS])),
])

HISTORY_PAGE = T.StructType([
    T.StructField("res", T.ArrayType(HISTORY_RECORD)),
    T.StructField("next_page_token", T.StringType()),
    T.StructField("has_more", T.BooleanType()),
])


def explode_records(pages: DataFrame, array_col: str = "res") -> DataFrame:
    """Records of every page, one row each (``explode`` of the array)."""
    return pages.select(F.explode(F.col(array_col)).alias("_r")).select("_r.*")


#: Largest file that is read as a whole when its lines aren't pages.
MAX_DOCUMENT_BYTES = 64 * 1024 * 1024

#: So many paths are sent to every executor at most.
BROADCAST_PATHS = 100_000

_DOCUMENTS = "file string, at long, state string, reason string, raw string, records array<string>"


_dumped = json.JSONEncoder(ensure_ascii=False, allow_nan=False).encode


class UnreadablePages(ValueError):
    """Landed JSON that is no page. ``path`` holds the ledger and the quarantine."""

    def __init__(self, message: str, path: str):
        super().__init__(message)
        self.path = path


@dataclasses.dataclass
class Landed:
    """What ``ingest`` has read; every frame is a table under ``path``."""
    records: DataFrame      # file, record (VARIANT)
    ledger: DataFrame       # a row per file
    quarantine: DataFrame   # file, at, reason, raw
    path: str


def _split(text: str, array: str) -> Iterator[tuple]:
    """(at, state, reason, raw, records) of the JSON values one after the other in
    ``text``. After a value that can't be read, lines that begin with ``{`` are tried
    again; what lies between is one unreadable stretch."""
    decoder, at, end, broken = json.JSONDecoder(), 0, len(text), None
    if text.startswith("\ufeff"):
        at = 1
    while True:
        while at < end and text[at].isspace():
            at += 1
        if at >= end:
            break
        try:
            value, after = decoder.raw_decode(text, at)
            pages = value if isinstance(value, list) else [value]
            found = []
            for page in pages:
                records = page.get(array) if isinstance(page, dict) else None
                if isinstance(page, dict) and array not in page and broken is None:
                    found.append((at, "bare", None, None, []))
                elif isinstance(records, list) and all(isinstance(r, dict) for r in records):
                    found.append((at, "page", None, None, [_dumped(r) for r in records]))
                else:
                    raise ValueError(f"no object with an array {array} of objects")
        except (ValueError, RecursionError) as exc:
            broken = broken or (at, str(exc)[:200])
            again = re.compile(r"\n[ \t]*(?=\{)").search(text, at)
            at = again.end() if again else end
            continue
        if broken:
            yield broken[0], "unreadable", broken[1], text[broken[0]:at], []
            broken = None
        yield from found
        at = after
    if broken:
        yield broken[0], "unreadable", broken[1], text[broken[0]:], []


def _documents(batches: Iterator[pa.RecordBatch], array: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):     # a row is a file: one at a time
            file, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            rows = [(file, *r) for r in _split(text, array)]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                             names=["file", "at", "state", "reason", "raw", "records"])


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _plain_path(file: str) -> str:
    """A path of ``_metadata.file_path`` as a reader takes it: decoded, nothing in it a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def ingest(spark: SparkSession, path, array: str, work_dir: str | None = None, on_unreadable: str = "fail",
           max_document_bytes: int = MAX_DOCUMENT_BYTES) -> Landed:
    """Read the landed JSON responses under ``path`` (a folder, sub-folders included, or
    paths) and account for all of them.

    Lines are read once, as text, and parsed to VARIANT: a page is an object with an array
    ``array`` of objects; an object without it is a page of no records. A file with any
    other line (a response printed over several lines, a truncated one) is read again as a
    whole, if it has at most ``max_document_bytes``, and split into its JSON values. What is
    still no page goes to the quarantine with its place and reason, and
    ``on_unreadable="fail"`` (default) then raises ``UnreadablePages``; ``"quarantine"``
    goes on with the rest.

    ``ledger`` has a row per file listed: (file, bytes, form, pages, records, unreadable,
    status); form is lines, document or empty, status read, partly, unreadable or empty.
    Pages are the readable ones; each stretch that isn't is counted in ``unreadable``.
    The tables lie under ``work_dir`` (default: a new folder in ``spark.checkpoint.dir``).
    """
    if on_unreadable not in ("fail", "quarantine"):
        raise ValueError("on_unreadable must be 'fail' or 'quarantine'")
    work = (work_dir or f"{shared_dir(spark)}/landed-json-{uuid.uuid4().hex}").rstrip("/")

    def stored(df: DataFrame, name: str) -> DataFrame:
        # Records as they are: to infer columns for their fields takes longer than to parse them.
        with _setting(spark, "spark.sql.variant.inferShreddingSchema", "false"):
            df.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    def listed(fmt: str, at, **options) -> DataFrame:
        # Few tasks list many paths each: a task for every file costs more than its look.
        with _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism)):
            return spark.read.options(recursiveFileLookup="true", **options).format(fmt).load(at)

    def paths(files: list[str]) -> DataFrame:
        return spark.createDataFrame(pa.table({"file": pa.array(files, pa.string())}))

    landed = listed("text", path)       # the one listing of all files
    trimmed = F.trim(F.col("value"), F.lit(" \t\r\n"))
    text = F.when(trimmed.startswith("\ufeff"), F.substr(trimmed, F.lit(2))).otherwise(trimmed)
    lines = landed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                          F.col("_metadata.file_block_start").alias("at"), text.alias("raw"))
    # A line is parsed up to the end of its first value only, so what follows is looked for apart.
    lines = lines.withColumn("keys", F.regexp_count(F.col("raw"), F.lit(r'"(?<!\\")' + re.escape(array) + r'"\s*:')))
    whole_line = F.col("raw").startswith("{") & F.col("raw").endswith("}") & (F.col("keys") <= 1)
    page = F.when(whole_line, F.try_parse_json("raw"))
    records = F.try_variant_get(F.col("page"), f"$.{array}" if array.isidentifier() else f"$['{array}']", "array<variant>")
    lines = lines.withColumn("page", page).withColumn("records", records)
    # As an object without a field to build: that of every field as a variant costs more than the parsing.
    objects = F.forall("records", lambda r: F.try_variant_get(r, "$", "struct<>").isNotNull())
    state = (F.when(F.col("raw") == "", "blank").when(F.col("records").isNotNull() & objects, "page")
             .when((F.col("keys") == 0) & F.col("page").isNotNull(), "bare").otherwise("odd"))
    lines = lines.withColumn("state", state)
    # A row per record, at least one per line: a reader's batch has rows of bounded size, and counts don't read the records.
    # The text of odd lines is needed only where the file isn't read again.
    raw = F.when((F.col("state") == "odd") & (F.col("bytes") > max_document_bytes), F.col("raw")).alias("raw")
    lines = stored(lines.select("file", "bytes", "at", "state", raw,
                                F.posexplode_outer(F.when(F.col("state") == "page", F.col("records"))).alias("pos", "record")), "lines")

    # Scans skip files of no bytes, the listing has them.
    files = paths([re.sub("^file:/+", "file:/", f) for f in landed.inputFiles()])
    first = F.coalesce("pos", F.lit(0)) == 0
    counted = lines.groupBy("file").agg(F.max("bytes").alias("bytes"), F.count("pos").alias("n"),
                                        *[F.count(F.when((F.col("state") == s) & first, 1)).alias(s) for s in ("page", "bare", "odd")])
    counted = stored(files.join(counted, "file", "left"), "files")
    silent = [r["file"] for r in counted.where("bytes is null").select("file").collect()]
    sizes = spark.range(0).selectExpr("cast(id as string) as file", "id as length")
    if silent:      # of no bytes, or compressed
        sizes = listed("binaryFile", [_plain_path(f) for f in silent]).select(F.col("_metadata.file_path").alias("file"), "length")
    # Paths on the driver: no more than its listing of the folder holds anyway.
    odd = counted.where((F.col("odd") > 0) | ((F.col("page") == 0) & (F.col("bare") > 0))).where(F.col("bytes") <= max_document_bytes)
    odd = {r["file"]: r["n"] for r in odd.select("file", "n").collect()}
    mixed = [f for f, n in odd.items() if n]
    if odd:
        whole = listed("text", [_plain_path(f) for f in odd], wholetext="true")
        documents = whole.select(F.col("_metadata.file_path").alias("file"), "value").mapInArrow(lambda b: _documents(b, array), _DOCUMENTS)
    else:
        documents = spark.createDataFrame([], _DOCUMENTS)
    documents = documents.select("file", "at", "state", "reason", "raw", F.posexplode_outer("records").alias("pos", "record"))
    documents = stored(documents.withColumn("record", F.parse_json("record")), "documents")

    # Records of the lines of a file that is read again are dropped; few files have both.
    kept = lines.where("pos is not null")
    if mixed:
        again = paths(mixed)
        kept = kept.join(F.broadcast(again) if len(mixed) <= BROADCAST_PATHS else again, "file", "left_anti")
    found = kept.select("file", "pos", "record").unionByName(documents.select("file", "pos", "record")).where("pos is not null")
    split = documents.groupBy("file").agg(*[F.count(F.when((F.col("state") == s) & first, 1)).alias(f"d_{s}") for s in ("page", "bare", "unreadable")],
                                          F.count("pos").alias("d_n"))
    as_document = F.col("d_page").isNotNull()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    form = F.when(as_document, "document").when(F.col("page") + F.col("bare") + F.col("odd") > 0, "lines").otherwise("empty")
    pages = F.when(as_document, zero("d_page") + zero("d_bare")).otherwise(zero("page") + zero("bare"))
    unreadable = F.when(as_document, zero("d_unreadable")).otherwise(zero("odd"))
    status = (F.when(F.col("form") == "empty", "empty").when(F.col("unreadable") == 0, "read")
              .when(F.col("pages") > 0, "partly").otherwise("unreadable"))
    size = F.coalesce("bytes", "length", F.lit(0).cast("long")).alias("bytes")
    ledger = counted.join(split, "file", "left").join(sizes, "file", "left").select("file", size, form.alias("form"), pages.alias("pages"),
                                                        F.when(as_document, zero("d_n")).otherwise(zero("n")).cast("long").alias("records"), unreadable.alias("unreadable"))
    ledger = stored(ledger.withColumn("status", status), "ledger")
    quarantine = stored(lines.where("raw is not null").select("file", "at", F.lit("line of a large file").alias("reason"), "raw")
                        .unionByName(documents.where("state = 'unreadable'").select("file", "at", "reason", "raw")), "quarantine")
    lost = ledger.where("unreadable > 0").agg(F.count(F.lit(1)).alias("files"), F.sum("unreadable").alias("pages"), F.min("file").alias("first")).first()
    if lost["files"] and on_unreadable == "fail":
        raise UnreadablePages(f"{lost['pages']} unreadable pages in {lost['files']} files, such as {lost['first']}: see {work}/quarantine", work)
    return Landed(found.select("file", "record"), ledger, quarantine, work)


def _type_text(dtype: T.DataType) -> str:
    """A type as ``variant_get`` takes it. Fractions become doubles, long integers decimals;
    what is of several types, and what is never there, text."""
    if isinstance(dtype, T.StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_type_text(f.dataType)}" for f in dtype.fields) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"array<{_type_text(dtype.elementType)}>"
    if isinstance(dtype, T.DecimalType):
        return "double" if dtype.scale else "decimal(38,0)" if dtype.precision > 18 else "bigint"
    return "string" if isinstance(dtype, (T.VariantType, T.NullType)) else dtype.simpleString()


_QUOTED = re.compile(r"`(?:[^`]|``)*`")


def merged_schema(records: DataFrame, column: str = "record") -> T.StructType:
    """The schema that holds every key of all of ``column``'s VARIANT objects, in one
    aggregate over them."""
    found = records.agg(F.schema_of_variant_agg(column)).first()[0]
    if not found.startswith("OBJECT<"):
        return T.StructType([])
    at, out = 0, []
    for name in _QUOTED.finditer(found):
        out += [found[at:name.start()].replace("OBJECT<", "STRUCT<"), name.group()]
        at = name.end()
    return T.DataType.fromDDL("".join(out) + found[at:].replace("OBJECT<", "STRUCT<"))


def shaped(records: DataFrame, schema: T.StructType | None = None, column: str = "record") -> DataFrame:
    """VARIANT records as columns. Without a schema, those of ``merged_schema``; a field
    whose value doesn't fit its type is null, as is one that is absent."""
    schema = merged_schema(records, column) if schema is None else schema
    if not schema.fields:
        return records.select(F.lit(None).alias("none")).drop("none")
    # A generator's rows: a filter on them isn't pushed below it, where it would read the record again for each field it names.
    return records.select(F.inline(F.array(F.try_variant_get(F.col(column), "$", _type_text(schema)))))


def read_history_pages(spark: SparkSession, path: str, schema: T.StructType = HISTORY_PAGE, **options) -> DataFrame:
    """Landed history pages -> one row per query record. ``options`` are those of ``ingest``."""
    return shaped(ingest(spark, path, "res", **options).records, schema["res"].dataType.elementType)


def read_executions(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """Landed batched execution responses (``QueryExecutions[]``) -> one row per
    execution. Without a schema every key of any record is a column; the landed text is
    read once either way. ``options`` are those of ``ingest``."""
    if schema is not None and "QueryExecutions" in schema.names:
        schema = schema["QueryExecutions"].dataType.elementType
    return utc_times(shaped(ingest(spark, path, "QueryExecutions", **options).records, schema))


# The times of an execution's status.
STATUS_TIMES = ("SubmissionDateTime", "CompletionDateTime")


def utc_times(executions: DataFrame) -> DataFrame:
    """Execution times as UTC wall times, parsed once at the source. JSON text may
    carry an offset (``2024-01-05T01:00:00+02:00``); without one it is UTC; numbers
    are epoch seconds. What can't be parsed is null, as if it were missing."""
    if "Status" not in executions.columns or not isinstance(executions.schema["Status"].dataType, T.StructType):
        return executions
    status = F.col("Status")
    for f in executions.schema["Status"].dataType.fields:
        if f.name not in STATUS_TIMES or isinstance(f.dataType, T.TimestampNTZType):
            continue
        c = F.col("Status").getField(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.try_to_timestamp(c)
        elif isinstance(f.dataType, T.NumericType):
            c = F.timestamp_micros((c.cast("decimal(20,6)") * 1_000_000).cast("long"))
        status = status.withField(f.name, c.cast("timestamp").cast("timestamp_ntz"))
    require_utc(executions)
    return executions.withColumn("Status", status)
