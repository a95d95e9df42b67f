"""Session helpers: settings and shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "logloom") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Small tables still use all cores; a cluster keeps Spark's own size.
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


_local: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster names for checkpoints.

    Only where that is unset and the master is local (tests), a temporary
    folder of this machine takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="logloom-"))
        base = _local[0]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write a small intermediate table once and read it back, so that the
    plans built on it do not repeat the work; survives lost executors.

    A job names a ``path`` of its own, which its next run overwrites.
    """
    path = path or shared_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
