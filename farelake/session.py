"""Session helpers: configuration defaults and a shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are instants rendered in UTC, so the
# session zone is pinned; everything else is left to the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A long-lived driver (stream, many increments) keeps only recent job history.
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "farelake", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs; on a cluster use the provided session."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = {**DEFAULT_CONF, **REQUIRED_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            # Local test files are one row group each; see sources.tables.spread.
            "spark.farelake.scan.partitions": str(shuffle_partitions)}
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session settings the jobs need (runtime SQL confs only)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised state.

    Uses the cluster's ``spark.checkpoint.dir`` (or the directory set on the
    SparkContext). Only in local runs and tests, where neither is set, a fresh
    temporary folder is created and registered as the checkpoint dir; on a
    cluster a folder of one machine would lose rows, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="farelake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root for one job's tables."""
    root = checkpoint_root(spark)
    return f"{root}/farelake/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, through the Hadoop file system."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jpath)
    return sorted(str(f.getPath()) for f in found or [])


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of finished job state through its Hadoop file system."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


__all__ = ["build_session", "prepare", "checkpoint_root", "scratch_path",
           "path_exists", "list_paths", "remove_path"]
