"""Corpus cleaning as five stages over ``documents``; each stage's rows are written as Parquet and read by the next.

toxicity: documents that the conditional random field rejects go.  exact dedup: of equal texts one stays.  n-gram Jaccard
join: of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest doc_id stays.  benchmark
decontamination: documents with a passage of ``benchmark`` go.  byte-level BPE: what is left is encoded and decoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspool.llm.byte_bpe import encode_table
from larkspool.llm.decontaminate import contaminated
from larkspool.llm.exact_dedup import exact_dedup
from larkspool.llm.jaccard_join import Jaccard, jaccard_groups
from larkspool.llm.scratch import forget, prepare, table, written
from larkspool.llm.toxicity import fit_field, without_toxic

#: A list of ids up to this many (8 bytes each) is broadcast; a longer one is joined by shuffling.
BROADCAST_IDS = 500_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_anti")


def _by_rows(docs: DataFrame, gone: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` without the rows that ``gone`` returns the doc_id of.

    ``gone`` decides on rows, each known by its own doc_id.  Where several rows share a doc_id, or have none, the rows are
    numbered in the order of doc_id (null last) and text first, so that each is judged by its own text.
    """
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return _without(docs, written(gone(docs).select("doc_id").distinct(), "pipeline_gone"))
    ordered = docs.select(F.struct(*docs.columns).alias("row")).orderBy(F.col("row.doc_id").asc_nulls_last(), "row.text")
    rows = written(ordered.select(F.monotonically_increasing_id().alias("doc_id"), "row"), "pipeline_rows")  # numbers increase with the order
    ids = written(gone(rows.select("doc_id", "row.text")).select("doc_id").distinct(), "pipeline_gone")
    return _without(rows, ids).select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows not predicted toxic by a field that is fitted on the labelled rows of ``docs``.

    Each row is judged by its whole text, null as empty; repeated rows are judged alike; an empty table stays empty.
    """
    prepare(spark)
    return without_toxic(docs, fit_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: most code points, then the smallest doc_id; null and empty are equal.

    Rows that share a doc_id are told apart by their texts; rows that repeat in all are one group like any other.
    """
    prepare(spark)
    return _by_rows(docs, lambda rows: exact_dedup(rows).where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies; texts without words, null among them, are near to none and stay."""
    prepare(spark)
    return _by_rows(docs, lambda rows: jaccard_groups(rows, Jaccard(size=5, percent=80)).where("doc_id <> component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark; null and empty texts, and all rows beside an empty benchmark, stay."""
    prepare(spark)
    return _by_rows(docs, lambda rows: contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every whole text (null: none): their number, and digests of the ids and of the decoded bytes."""
    prepare(spark)
    return encode_table(docs, keep_ids=False)


STAGES = [("toxicity", toxicity), ("exact_dedup", dedup), ("ngram_jaccard", near_dedup), ("decontamination", decontamination), ("byte_bpe", tokens)]
#: The conditional random field and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
        forget(*before)  # what this stage has read
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
