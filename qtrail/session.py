"""Session construction for tests, tools and the bench, plus the shared
scratch location (always under the cluster's ``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Day partition values are strings ('YYYY-MM-DD'); never infer dates.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "qtrail", extra: dict | None = None) -> SparkSession:
    """Master and shuffle partitions are those of the launcher unless given
    (tests, tools and the bench give them)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("QTRAIL_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; only when none is
    configured (local tests) is a private one set."""
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="qtrail-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir()
    return d


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder under the shared checkpoint location."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/qtrail/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table of this application."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clean_scratch(spark: SparkSession) -> bool:
    """Remove all scratch tables of this application, at its end: frames that
    read them can run no more."""
    from qtrail.sources.folders import delete
    return delete(spark, [scratch_root(spark)]) > 0


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings that keep every shuffle partition near ``target_partition_bytes``
    for a job reading ``input_bytes`` on ``total_cores`` cores.

    * shuffle partitions: enough for the target size, at least 2 waves of
      cores, so each reducer's sort / window buffer fits in executor memory;
      adaptive execution then coalesces small ones and splits skewed ones;
    * file splits of the same size for splittable inputs (Parquet);
    * broadcast only below 64 MB.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    }


def apply_conf(spark: SparkSession, conf: dict) -> None:
    """Set runtime SQL options on an existing (cluster-provided) session."""
    for k, v in conf.items():
        spark.conf.set(k, v)
