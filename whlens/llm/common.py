"""Helpers shared by the operators: tables in the shared folder, Arrow batches
and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting (tests) gets a temporary folder;
    on a cluster a missing setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(shared_dir, "_local"):
        shared_dir._local = "file://" + tempfile.mkdtemp(prefix="llm-")
    return shared_dir._local


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: a cut in the lineage
    that outlives any executor."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return reread(df.sparkSession, path, df.schema)


def reread(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by ``table`` that nothing needs any more."""
    if path := getattr(df, "stored_at", None):
        jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Rows of a batch between the JVM and Python where rows hold whole texts.
TEXT_ROWS = 1000


def text_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch to ``TEXT_ROWS``: its default of 10,000
    is meant for narrow rows, and both sides hold a batch and its copies."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a flat DDL list such as ``doc_id long, ids binary``."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
             "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
             "array<string>": pa.list_(pa.string()), "array<float>": pa.list_(pa.float32()), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(f.rpartition(" ")[0].strip(), kinds[f.rpartition(" ")[2]]) for f in ddl.split(", ")])


SALTS = 16


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, component), where
    component is the smallest node reachable. Nodes without an edge don't appear.

    Min-label hooking with pointer jumping, about log(n) rounds. A label may be
    that of a third of all nodes, so the look-up of a label's own label is salted;
    every other join has a node's own id as its key. Each round is a table in the
    shared folder, and the round before it is deleted.
    """
    spark = edges.sparkSession
    both = table(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct(), "edges")
    state = table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = (both.join(state.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        seen = state.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        hooked = (seen.where("low < label").groupBy(F.col("label").alias("node")).agg(F.min("low").alias("hook")))
        moved = (seen.join(hooked, "node", "left")
                 .select("node", F.col("label").alias("old"), F.least("low", "hook").alias("label")))
        moved = table(moved, "labels")
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        # Only labels are looked up, so only nodes that are some node's label are repeated for the salts.
        heads = (moved.select(F.col("label").alias("node")).distinct().join(moved.select("node", F.col("label").alias("top")), "node")
                 .select(F.col("node").alias("label"), F.least("node", "top").alias("top"), salts))
        jumped = (moved.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
                  .join(heads, ["label", "salt"], "left")
                  .select("node", F.coalesce("top", "label").alias("label"), "old"))
        new = table(jumped, "labels")
        changed = not new.where("label <> old").isEmpty()
        drop(moved), drop(state)
        state = new
        if not changed:
            drop(both)
            return state.select("node", F.col("label").alias("component"))
    raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
