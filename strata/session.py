"""Session construction and the shared scratch location.

Jobs that must cut lineage or stage files write below the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: adaptive execution re-plans joins and shuffle widths from
# runtime statistics, splits skewed partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster pass ``master=None`` and let the launcher decide; ``shuffle_partitions`` should
    then be sized so that one shuffle partition holds roughly 128-256 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) gets a temporary folder when the setting is absent;
    on a cluster a driver-local folder would be invisible to executors, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/strata/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop(spark: SparkSession, path: str):
    """(Hadoop path, its file system)"""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop(spark, path)
    return fs.exists(jpath)


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark lists files."""
    jpath, fs = _hadoop(spark, path)
    return fs.makeQualified(jpath).toString()


def remove_path(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop(spark, path)
    return fs.delete(jpath, True)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    jpath, fs = _hadoop(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(jpath) or []]
