"""Session settings and the shared working folder.

Every file this library writes (bronze, silver, gold, queue versions, run
logs, stream checkpoints) lives under one shared folder.  On a cluster that
folder is the one the cluster names in ``spark.checkpoint.dir``; it is read
from the session and never replaced.  Only when it is unset (a laptop, a
unit test) a local folder is created and set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on.  AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; UTC keeps clock columns stable; dynamic
# partition overwrite keeps partitions a landing does not touch.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where two joins in a row share one shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tierline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on a session built elsewhere.

    Directory listing of a partitioned layout runs as a Spark job; its task
    count is sized to the cluster (four per core, at most Spark's default of
    10,000) rather than fixed, so a small cluster does not pay for
    thousands of listing tasks.
    """
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   str(min(10_000, 4 * cores)))


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Set only when unset, which happens in tests and on a laptop.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tierline-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, *parts: str) -> str:
    """A folder private to this application under the shared root."""
    app = spark.sparkContext.applicationId
    return "/".join([shared_root(spark), "tierline", app, *parts])


def fresh_folder(spark: SparkSession, *parts: str) -> str:
    """A new, unused folder under this application's run folder."""
    return run_folder(spark, *parts, uuid.uuid4().hex[:12])


def local_path(path: str) -> str | None:
    """The local path of a ``file:`` URI or plain path, else None."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return os.path.abspath(path)
