"""Continuous ingestion: each micro-batch of payloads is deduplicated and merged into a snapshot table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import SnapshotTable, bronze_rows, dedupe_last


def merge_batch(table: SnapshotTable, clock: Callable[[], str]) -> Callable[[DataFrame, int], None]:
    """A sink for ``foreachBatch``; merging a batch again after a failure changes nothing but the times."""

    def put(batch: DataFrame, number: int) -> None:
        rows = bronze_rows(batch.drop("arrival"), clock()).withColumn("arrival", F.monotonically_increasing_id())
        once = dedupe_last(rows, table.keys, ["arrival"]).drop("arrival")
        if not once.isEmpty():
            table.merge(once, ["ingestion_id", "raw_text", "metadata", "ingested_at"])

    return put


def ingest(payloads: DataFrame, table: SnapshotTable, checkpoint: str, clock: Callable[[], str]) -> StreamingQuery:
    """Start merging a stream of payloads(doc_type, source_id, raw_text, metadata); it ends when all there is was read."""
    sink = payloads.writeStream.foreachBatch(merge_batch(table, clock)).option("checkpointLocation", checkpoint)
    return sink.trigger(availableNow=True).start()
