"""Sessions for tests and benches, and shipping this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the engine relies on: UTC, adaptive execution, few shuffle partitions."""
    builder = SparkSession.builder.master(f"local[{cores}]")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each context; they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_larkspool_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="larkspool-"), "larkspool.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("larkspool", os.path.relpath(path, top)))
    context.addPyFile(target)
    context._larkspool_shipped = True


#: Inputs of more bytes than this are never dealt anew: they have files enough, or their reader splits them.
SPREAD_BYTES = 1 << 30


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt to all cores if they come in fewer partitions than there are cores, as one small file does.

    Large inputs stay as they are, whatever the number of cores: nothing is shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= cores:
        return rows
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return rows.repartition(cores) if int(str(size)) <= SPREAD_BYTES else rows
