"""What every operator here needs of its session: the shared scratch folder, the package on the executors, small batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..scratch import forget, forget_paths, shared_dir, table_path, written
from ..session import ship_package, spread

__all__ = ["forget", "forget_paths", "prepare", "shared_dir", "table", "table_path", "written"]
#: Rows of an Arrow batch unless the session says otherwise: whole texts are long rows, and a batch is held on both sides.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Send the package to the executors, and keep Arrow batches small where the session has no setting of its own."""
    ship_package(spark)
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, dealt to all cores if it is one small file."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
