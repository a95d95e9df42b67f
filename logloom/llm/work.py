"""Shared working folder: intermediate tables that outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Only where that is unset and the master is local (tests), a temporary
    folder of this machine takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="llm-work-"))
        base = _local[0]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table once and read it back: cuts the lineage, keeps its size known to the planner."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
