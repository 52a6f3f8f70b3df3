"""Session construction and the few session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job needs: UTC so that timestamp literals and epoch
# conversions do not depend on the machine zone, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast
# conversion from real shuffle statistics), and no web UI.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.scheduler.mode": "FAIR",     # exports side by side share the executors
}


def build_session(master: str | None = None, app_name: str = "whlens",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings above.

    On a cluster ``master`` stays ``None`` (taken from spark-submit) and
    ``shuffle_partitions`` is left to the cluster default / AQE.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may return an existing session: apply the SQL settings anyway.
    for k, v in REQUIRED_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The setting names a path that all executors share; nothing else would
    survive a lost one, so its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def shared_dir(spark: SparkSession) -> str:
    """The folder for tables between jobs: ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder; on a cluster that is an error."""
    local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
    if local and not spark.conf.get("spark.checkpoint.dir", None):
        if not hasattr(shared_dir, "_local"):
            shared_dir._local = "file://" + tempfile.mkdtemp(prefix="whlens-")
        return shared_dir._local
    return ensure_checkpoint_dir(spark).rstrip("/")


def sizing_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
                max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Session settings sized for ``input_bytes`` of landed data.

    Scan splits and AQE's target post-shuffle partition are both
    ``target_partition_bytes`` (fits executor memory with room for sort
    buffers); the initial shuffle partition count covers the input at that
    size up to a cap, and AQE coalesces small partitions afterwards. Exports
    shuffle filtered, projected rows, far less than the input; for 100 TB at
    256 MB the count is the cap, 100,000."""
    parts = max(200, min(max_shuffle_partitions, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
