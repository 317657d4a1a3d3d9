"""Spark session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "cardwatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC timestamps, ANSI arithmetic and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the session names it.

    Without a named one it is below the home folder of the default file system; only a local session
    takes a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            named = tempfile.mkdtemp(prefix="cardwatch-")
        else:
            files = sc._jvm.org.apache.hadoop.fs.FileSystem.get(sc._jsc.hadoopConfiguration())
            named = f"{files.getHomeDirectory().toString()}/cardwatch/{sc.applicationId}"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def with_package(spark: SparkSession) -> None:
    """Let Python workers that start from now on import this package from where the driver has it.

    Changes nothing where PYTHONPATH names the folder; on a cluster install the package on all nodes.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def run_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created until Spark writes there."""
    return f"{shared_dir(spark).rstrip('/')}/cardwatch/{label}-{uuid.uuid4().hex}"
