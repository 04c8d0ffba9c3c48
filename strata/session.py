"""Spark session helpers: UTC clock, ANSI casts, adaptive execution."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for exact results: timestamps are read and
# written in UTC, casts raise on overflow (ANSI), and AQE re-plans shuffles
# (partition coalescing, skew-join splitting) from runtime statistics. Of a
# member that a JSON object holds several times the last one counts.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Pin the settings the library depends on on an existing session."""
    for key, value in CORE_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names storage every executor can
    reach; it is read from the session and never replaced, and a cluster
    session without it is an error. Only a local session, whose executors are
    threads of the driver, gets a private scratch folder.
    """
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to storage that the driver and every executor can reach")
        base = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base.rstrip("/") + "/" + name


def scale_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024, min_partitions: int = 200, max_partitions: int = 200_000) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` (e.g. 100 TB on a large cluster).

    Shuffles start with about one partition per ``partition_bytes`` of input
    (bounded), and AQE coalesces them to the advisory size at run time, so
    each task's share fits comfortably in executor memory and spills stay
    rare. Scan splits use the same size. A shuffle partition more than 4x the
    median and over 512 MB counts as skewed and is split by AQE's skew join.
    """
    parts = max(min_partitions, min(max_partitions, -(-input_bytes // partition_bytes)))
    size = f"{partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    }


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return total


def tune_for_inputs(spark: SparkSession, paths: list[str], partition_bytes: int = 256 * 1024 * 1024, min_partitions: int = 200) -> dict[str, str]:
    """Apply ``scale_conf`` for the measured size of ``paths``; returns what was set."""
    conf = scale_conf(input_bytes(spark, paths), partition_bytes, min_partitions)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf
