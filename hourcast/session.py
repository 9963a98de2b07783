"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "hourcast") -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster the caller brings the session; nothing in the library sets
    shuffle partitions or memory.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors, taken from the session.

    Only a local session that names none gets a temporary folder; a cluster
    without a shared folder is an error.
    """
    context = spark.sparkContext
    folder = (
        context.getCheckpointDir()
        or spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
    )
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="hourcast-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/hourcast-{uuid.uuid4().hex}/{name}"
