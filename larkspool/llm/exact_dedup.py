"""Exact deduplication against a persistent digest index, bucketed and sorted by digest."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import forget_paths, shared_dir, table, written

SPACES = " \t\n\x0b\x0c\r"
_COLUMNS = "digest binary, n_points bigint, doc_id bigint"


def _best(prefix: str = "") -> Column:
    """The deciding order of equal texts: most code points first, then the smallest id (null behind all others)."""
    n, d = F.col(f"{prefix}n_points"), F.col(f"{prefix}doc_id")
    return F.struct((-n).alias("less"), d.isNull().alias("no_id"), d.alias("doc_id"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the text without ASCII white space; null counts as empty) and code points."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.encode(F.translate(text, SPACES, ""), "UTF-8"), 256)).alias("digest"),
        F.length(text).cast("long").alias("n_points"),
    )


class DigestIndex:
    """The digests seen so far with the document that stays for each, in a folder that outlives the session.

    The folder holds Parquet files bucketed and sorted by digest, which only ever are appended to, and beside it a small
    manifest with the number of buckets; any session that finds the manifest goes on with the index.  Deduplicating new
    rows is a sort-merge join that shuffles the new rows' digests only (32 bytes each, never texts, never the index).
    A digest may have several rows: a later document that comes before the one that stayed (see ``_best``) is appended too.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = (path or f"{shared_dir(spark)}/larkspool/digest_index-{uuid.uuid4().hex}").rstrip("/")
        known = self._manifest()
        self.buckets = known or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if known is None:
            if self._exists(self.path):
                raise ValueError(f"{self.path} holds files but no manifest of an index stands beside it")
            spark.createDataFrame([(json.dumps({"buckets": self.buckets}),)], "value string").coalesce(1).write.text(f"{self.path}.manifest")
        # the catalogue's entry is only this session's view of the folder
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} ({_COLUMNS}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def _exists(self, path: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _manifest(self) -> int | None:
        if not self._exists(f"{self.path}.manifest/_SUCCESS"):
            return None
        return int(json.loads(self.spark.read.text(f"{self.path}.manifest").first()[0])["buckets"])

    def close(self, delete: bool = False) -> None:
        """Take the index out of this session's catalogue; its files stay, unless they are to be deleted."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if delete:
            forget_paths(self.spark, self.path, f"{self.path}.manifest")

    def table(self) -> DataFrame:
        """Rows (digest, n_points, doc_id) of the index."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def keepers(self) -> DataFrame:
        """digest and the best row of each: no shuffle, as the files are bucketed by digest."""
        return self.table().groupBy("digest").agg(F.min(_best()).alias("old"))

    def _append(self, fresh: DataFrame) -> None:
        (fresh.select("digest", "n_points", "doc_id").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))

    def add(self, docs: DataFrame) -> DataFrame:
        """Deduplicate ``docs`` in themselves and against the index; append what is new.

        Returns for every row, dropped ones too: doc_id, keep_id, group_size (rows of this call), kept, text_sha256.
        ``keep_id`` is the best document of all that the index has seen.  Repeated rows with one doc_id count as that many
        rows; the first in order stays, and all of them share ``kept``.
        """
        rows = written(digests(docs), "digest_rows")  # texts are hashed once
        winners = rows.groupBy("digest").agg(F.min(_best()).alias("best"), F.count("*").alias("group_size"))
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            winners = winners.repartition(self.buckets, "digest")
        winners = winners.select("digest", "best", (-F.col("best.less")).alias("n_points"), F.col("best.doc_id").alias("doc_id"), "group_size")
        # new digests: anti-join, then those that are there with what the index says
        fresh = winners.join(self.table().select("digest").hint("merge"), "digest", "left_anti").withColumn("old", F.lit(None).cast("struct<less: bigint, no_id: boolean, doc_id: bigint>"))
        again = winners.join(self.keepers().hint("merge"), "digest")
        chosen = written(fresh.unionByName(again), "digest_winners")
        self._append(chosen.where("old is null or best < old").repartition(self.buckets, "digest"))
        first = chosen.select("digest", F.least("best", "old").getField("doc_id").alias("keep_id"), "group_size")
        return rows.join(first, "digest").select(
            "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
        )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Verdict for every row of ``docs(doc_id, text, ...)``; texts are equal without ASCII white space.

    Without ``index`` a new and empty one is used, and deleted in the end; the steps are the same.  Null and empty texts are one group; texts of
    any length are hashed whole; ties fall to the smallest doc_id, rows without one behind all others; an empty table gives
    no rows; other columns, whatever their names, are not looked at.
    """
    own = index or DigestIndex(docs.sparkSession)
    out = own.add(docs)
    if index is None:
        own.close(delete=True)  # what was asked has been written
    return out


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
"""
