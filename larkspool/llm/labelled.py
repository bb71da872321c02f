"""Labelled rows for fitting: folds by a checksum of doc_id, and samples bounded for each class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    """doc_id and label, one row for each document; rows without either are left out, contradictions count as 1."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("label"))


def bounded(rows: DataFrame, column: str, each: int) -> DataFrame:
    """About ``each`` rows of every value of ``column`` at most, chosen by a hash of doc_id whatever the partitions.

    The share that is taken comes from exact counts; a value with fewer rows is taken whole.  The number of values must be
    small by its nature (labels, languages).
    """
    counts = {r[0]: r[1] for r in rows.groupBy(column).count().collect()}
    share = F.coalesce(*(F.when(F.col(column) == F.lit(v), F.lit(min(1.0, each / n))) for v, n in counts.items())) if counts else F.lit(1.0)
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_003)) < share * 1_000_003)
