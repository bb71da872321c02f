"""Shared scratch folder: lineage is cut by tables written where every executor can read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``; one of our own only where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jvm_dir.get() if jvm_dir.isDefined() else None
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="larkspool-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/larkspool/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: later stages start from the files."""
    path = table_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._larkspool_path = path
    return out


def forget_paths(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned.  Only for those whose last reader has itself been written: a table that a
    later stage is still to read from, or to read again after the loss of an executor, must stay."""
    for df in tables:
        forget_paths(df.sparkSession, df._larkspool_path)
