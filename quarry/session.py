"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (timestamp maths and oracle
# parity), adaptive execution (runtime coalescing, skew-join splitting and
# broadcast of sides that turn out small), and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with ``BASE_CONF``.

    On a cluster the session is normally created by the launcher; this only
    adds our defaults where they are not already set.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def cluster_conf(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle sizing for a cluster run over ``input_bytes`` of Parquet.

    AQE starts from enough partitions for ~``target_partition_bytes`` per
    task (so sort / window buffers fit the executor memory and spill rarely)
    and coalesces small ones at run time; skewed sort-merge partitions are
    split by AQE, skewed window keys by ``quarry.skew.hotKeyRows``.
    """
    initial = max(executor_cores * 3, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 << 20)),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "quarry.skew.hotKeyRows": str(2_000_000),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    It is the folder that the cluster names in ``spark.checkpoint.dir``.  Only
    a local master, whose executors share the driver's disk, may leave it
    unset; a temporary folder then serves the session.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def cut_lineage(df, name: str = "cut"):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    continue from it.

    Same role as a reliable ``checkpoint()`` (the copy survives executor
    loss; a local checkpoint is never used), but one job instead of two
    (count, then write with recomputation), and columnar compressed files
    instead of serialized rows.  Every call takes a fresh folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
