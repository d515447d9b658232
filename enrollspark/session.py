"""Spark session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the extract relies on; all are public Spark SQL options.
EXTRACT_CONF = {
    # runtime re-planning: size-checked broadcast of small sides, skew splits, partition coalescing
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # dates are formatted and compared the same wherever the driver runs
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "enrollspark") -> SparkSession:
    """A local session for tests and the benchmark (the UI stays off)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in EXTRACT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir``. Where the session names none, a local
    session gets a fresh folder under the system temp dir; on a cluster, whose
    machines don't share one, that is an error.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master})")
        d = tempfile.mkdtemp(prefix="enrollspark-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run made."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)
