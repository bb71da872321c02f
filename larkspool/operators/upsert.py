"""Idempotent upserts into Parquet snapshots, incremental loads, change feeds and batch plans."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import ship_package
from .staging import BRONZE_KEY, DOC_TYPES


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def dedupe_last(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``; one aggregation, so a key's rows are combined before the shuffle."""
    columns = rows.columns
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r"))
    return last.select(*(F.col(f"r.{c}").alias(c) for c in columns))


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None) -> DataFrame:
    """The merged rows of ``target`` and ``source`` with ``action``: insert, update or keep.

    A matched row takes the columns of ``update`` (all but the keys, unless given) from the source.  Raises on a key that
    the source holds twice, as a merge would be ambiguous; null keys match nothing.
    """
    if twice := duplicates(source, keys).limit(3).collect():
        raise ValueError(f"the source of a merge holds keys more than once, such as {[tuple(r)[:-1] for r in twice]}")
    columns = target.columns
    update = set(update if update is not None else [c for c in columns if c not in keys])
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    both, new = F.col("_t") & F.col("_s"), F.col("_t").isNull()

    def value(c: str) -> Column:
        take = new | both if c in update else new
        return F.when(F.coalesce(take, F.lit(False)), F.col(f"s.{c}") if c in source.columns else F.lit(None)).otherwise(F.col(f"t.{c}")).alias(c)

    action = F.when(new, "insert").when(F.col("_s").isNull(), "keep").otherwise("update").alias("action")
    return joined.select(*(value(c) for c in columns), action)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None) -> DataFrame:
    """The target after the merge."""
    return merge_actions(target, source, keys, update).drop("action")


def merge_receipt(actions: DataFrame) -> DataFrame:
    """inserted, updated and kept rows of ``merge_actions``, and status: inserted, updated or no_change."""
    counts = actions.agg(*(F.count_if(F.col("action") == a).alias(n) for a, n in (("insert", "inserted"), ("update", "updated"), ("keep", "kept"))))
    return counts.withColumn("status", F.when(F.col("inserted") > 0, "inserted").when(F.col("updated") > 0, "updated").otherwise("no_change"))


def newer_rows(source: DataFrame, target: DataFrame | None, column: str = "ingested_at") -> DataFrame:
    """Rows of ``source`` strictly after the latest of ``target``; all of them if the target is missing or empty.

    Rows of the same second as the latest one are left out, and so are null times.
    """
    if target is None:
        return source.where(F.col(column).isNotNull())
    mark = target.agg(F.coalesce(F.max(column), F.lit("1900-01-01").cast(target.schema[column].dataType)).alias("_mark"))
    return source.join(F.broadcast(mark), F.col(column) > F.col("_mark")).drop("_mark")


def incremental_merge(target: DataFrame | None, source: DataFrame, key: str = "chunk_id", column: str = "ingested_at", replace_by: str | None = None) -> DataFrame:
    """The target with the newer rows of the source merged in by ``key``; new columns are added, history is not filled.

    Nothing is deleted unless ``replace_by`` names a column: rows of the target that share its value with a newer row
    then go if that newer load does not hold their key.
    """
    fresh = newer_rows(source, target, column)
    if target is None:
        return fresh
    target = target.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema if f.name not in target.columns))
    if replace_by:
        target = target.join(fresh.select(replace_by).distinct(), replace_by, "left_anti").unionByName(target.join(fresh.select(key), key, "left_semi"))
    return merge_upsert(target, fresh, [key], [c for c in source.columns if c != key])


def change_feed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Changes between two snapshots: insert, delete, and update_preimage and update_postimage for rows that differ."""
    columns = new.columns
    o, n = old.select(key, F.struct(*columns).alias("o")), new.select(key, F.struct(*columns).alias("n"))
    joined = o.join(n, key, "full_outer").where(~F.col("o").eqNullSafe(F.col("n")))

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), F.col(row).alias("r"))

    changes = (
        F.when(F.col("o").isNull(), F.array(change("insert", "n")))
        .when(F.col("n").isNull(), F.array(change("delete", "o")))
        .otherwise(F.array(change("update_preimage", "o"), change("update_postimage", "n")))
    )
    return joined.select(F.explode(changes).alias("c")).select("c.change_type", "c.r.*")


def freshness(rows: DataFrame, now: str, column: str = "ingested_at", warn_days: int = 7, error_days: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """latest time, its age in days at ``now`` and status pass, warn or error (error without a time), for each ``by``."""
    latest = (rows.groupBy(*by) if by else rows.groupBy()).agg(F.max(column).alias("latest"))
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("latest").cast("timestamp"))) / 86400
    return latest.withColumn("age_days", F.round(age, 6)).withColumn("status", F.when(F.col("age_days") <= warn_days, "pass").when(F.col("age_days") <= error_days, "warn").otherwise("error"))


def row_bytes(columns: Sequence[str]) -> Column:
    """Bytes of a row's values as text in UTF-8; null counts as empty."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return total


def plan_batches(rows: DataFrame, order: Sequence[str], size: Column, group: Sequence[str] = (), budget: int = 800_000, most: int = 40) -> DataFrame:
    """``row_bytes`` and ``batch`` (from 0 in each group) of every row: batches are filled in order up to ``budget`` bytes and
    ``most`` rows.

    A row over the budget has a batch of its own.  The fill is sequential in its nature: the rows of one group (a load, a
    partition, a day) pass through one task in order, which holds no more than a batch of Arrow rows and a running sum.
    Null sizes count as 0.
    """
    ship_package(rows.sparkSession)
    columns, places = rows.columns, [rows.columns.index(g) for g in group]
    sized = rows.withColumn("row_bytes", F.coalesce(size.cast("long"), F.lit(0)))
    sized = sized.repartition(*(F.col(g) for g in group)) if group else sized.repartition(1)
    sized = sized.sortWithinPartitions(*group, *order)
    schema = StructType([*sized.schema.fields, StructField("batch", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n, number = None, 0, 0, 0
        for part in batches:
            keys = list(zip(*(part.column(i).to_pylist() for i in places), strict=True)) if places else [()] * part.num_rows
            out = []
            for key, weight in zip(keys, part.column(len(columns)).to_pylist(), strict=True):
                if key != now:
                    now, held, n, number = key, 0, 0, 0
                elif held + weight > budget or n >= most:
                    held, n, number = 0, 0, number + 1
                held += weight
                n += 1
                out.append(number)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.int32())], [*part.schema.names, "batch"])

    return sized.mapInArrow(run, schema)


def checked_payloads(rows: DataFrame, required: Sequence[str] = ("doc_type", "source_id", "raw_text")) -> DataFrame:
    """The rows, which raise when read if a required field is missing or empty or the kind of document is unknown."""
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull() | (F.col(c) == "")
    bad = bad | ~F.col("doc_type").isin(*DOC_TYPES)
    message = F.concat(F.lit("payload with a missing field or an unknown doc_type: "), F.coalesce(F.col("source_id"), F.lit("(no source_id)")))
    return rows.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))


def bronze_rows(payloads: DataFrame, ingested_at: str) -> DataFrame:
    """Rows for the bronze table from payloads(doc_type, source_id, raw_text, metadata as JSON or null)."""
    return checked_payloads(payloads).select(
        F.expr("uuid()").alias("ingestion_id"), "doc_type", "source_id", "raw_text", F.coalesce("metadata", F.lit("{}")).alias("metadata"), F.lit(ingested_at).cast("timestamp").alias("ingested_at")
    )


class SnapshotTable:
    """A table as versioned Parquet snapshots under one folder; readers see the last version that was finished.

    Stands in for a transactional table format: a merge writes a new snapshot once, then the pointer to it.  Snapshots hold
    what the merge did with each row too (``_action``), which readers do not see.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = BRONZE_KEY):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)

    def _pointer(self) -> DataFrame | None:
        try:
            return self.spark.read.json(f"{self.path}/versions", schema="version long, folder string")
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def versions(self) -> list[tuple[int, str]]:
        rows = self._pointer()
        return [] if rows is None else sorted((r["version"], r["folder"]) for r in rows.collect())

    def read(self, version: int | None = None) -> DataFrame | None:
        known = dict(self.versions())
        if not known:
            return None
        return self.spark.read.parquet(f"{self.path}/{known[max(known) if version is None else version]}").drop("_action")

    def write(self, rows: DataFrame) -> int:
        version = max((v for v, _ in self.versions()), default=-1) + 1
        folder = f"v{version}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return self._publish(version, folder)

    def _publish(self, version: int, folder: str) -> int:
        self.spark.createDataFrame([(version, folder)], "version long, folder string").coalesce(1).write.mode("append").json(f"{self.path}/versions")
        return version

    def merge(self, source: DataFrame, update: Sequence[str] | None = None) -> dict:
        """Merge and return the receipt; the first merge inserts everything."""
        target = self.read()
        if target is None:
            target = self.spark.createDataFrame([], source.schema)
        version = max((v for v, _ in self.versions()), default=-1) + 1
        folder = f"v{version}-{uuid.uuid4().hex}"
        merge_actions(target, source, self.keys, update).withColumnRenamed("action", "_action").write.parquet(f"{self.path}/{folder}")
        done = self.spark.read.parquet(f"{self.path}/{folder}").withColumnRenamed("_action", "action")
        receipt = merge_receipt(done).first().asDict()
        self._publish(version, folder)
        return receipt

    def changes(self, old: int, new: int, key: str) -> DataFrame:
        return change_feed(self.read(old), self.read(new), key)
