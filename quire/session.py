"""Session and shared-folder helpers.

The library never forces cluster settings on a session it is handed. The
builder here is for tests, the bench and local runs; on a cluster the job
owner's session (and its ``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quire") -> SparkSession:
    """A session with the settings the library assumes (UTC, AQE, no UI)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("QUIRE_DRIVER_MEMORY", "8g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests, single-machine runs) gets a
    temporary folder; a cluster session must name a shared folder, since a
    machine-local one would not survive losing that machine.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                               "before running jobs that land intermediate data")
        root = tempfile.mkdtemp(prefix="quire-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def stream_checkpoint(spark: SparkSession, name: str, beside: str | None) -> str:
    """Where a stream without a given checkpoint keeps it: a fixed folder beside
    its output, or under ``spark.checkpoint.dir``, so that a restarted job
    resumes."""
    if beside:
        return f"{beside.rstrip('/')}/_checkpoint"
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError(f"stream {name}: give a checkpoint, or set spark.checkpoint.dir")
    return f"{root.rstrip('/')}/streams/{name}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a landed intermediate table."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# Rows of a task of an exchange whose tasks hold what they read.
TASK_ROWS, MAX_TASK_ROWS = 250_000, 1_000_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Partitions for an exchange of so many rows: ``TASK_ROWS`` each as far as the
    session's shuffle partitions go, ``MAX_TASK_ROWS`` beyond, so that what a task
    sorts or hashes does not grow with the table (bytes of narrow, well compressed
    rows say little about the memory they take)."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, -(-rows // TASK_ROWS)), -(-rows // MAX_TASK_ROWS))
