"""Files as tables: word-processor documents, payload lists, questions and catalogues; and sinks for them."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.controls import catalog_groups
from ..session import ship_package

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_lines(data: bytes) -> list[str]:
    """Lines of a .docx in document order: breaks end a line, a paragraph's start ends one that is not empty."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        nodes = ET.fromstring(archive.read("word/document.xml")).iter()
    lines, line = [], []
    for node in nodes:
        kind = node.tag.removeprefix(_W)
        if kind in ("br", "cr") or (kind == "p" and line):
            lines.append("".join(line))
            line = []
        elif kind == "t":
            line.append(node.text or "")
        elif kind == "tab":
            line.append("\t")
    return lines + ["".join(line)] * bool(line)


def read_docx(spark: SparkSession, folder: str, pattern: str = "*.docx", ordered: bool = False) -> DataFrame:
    """file and lines of every document in a folder, by file name if ``ordered``; a file that is no .docx has no lines."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data in batch.column(1).to_pylist():
                try:
                    found.append(docx_lines(data))
                except (zipfile.BadZipFile, KeyError, ET.ParseError):
                    found.append([])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["file", "lines"])

    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInArrow(run, "file string, lines array<string>")
    return rows.orderBy("file") if ordered else rows


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """doc_type, source_id, raw_text and metadata (JSON) of a file with one payload or a list of them."""
    whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    kind = F.schema_of_variant("v")
    shaped = whole.where(F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), True).otherwise(F.raise_error(F.lit("a payload file holds an object or a list of objects")).cast("boolean")))
    listed = F.from_json(F.when(kind.startswith("ARRAY"), F.to_json("v")).otherwise(F.concat(F.lit("["), F.to_json("v"), F.lit("]"))), "array<string>")
    rows = shaped.select(F.explode(listed).alias("p"))
    return rows.select(*(F.get_json_object("p", f"$.{c}").alias(c) for c in ("doc_type", "source_id", "raw_text", "metadata")))


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Payloads as lines of JSON, the metadata as an object of its own."""
    payloads.select(F.to_json(F.struct("doc_type", "source_id", "raw_text", F.parse_json("metadata").alias("metadata"))).alias("value")).write.text(path)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """query_id, question, targets, class and answer_locus of a YAML file of labelled questions."""
    import yaml

    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    rows = [
        (q["id"], q["question"], [(t["source_id"], t.get("section_key")) for t in q["targets"]], q.get("class", "contested"), q.get("answer_locus", "unknown"))
        for q in yaml.safe_load(text)["questions"]
    ]
    return spark.createDataFrame(rows, "query_id string, question string, targets array<struct<source_id: string, section_key: string>>, class string, answer_locus string")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue file's groups, a family in each row."""
    return catalog_groups(spark.read.text(path, wholetext=True))


def read_profiles(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """baseline, place and value (the profile as JSON) of profile files by the baselines' names, in their order."""
    files = [spark.read.text(path, wholetext=True).select(F.lit(name).alias("baseline"), F.lit(place).alias("place"), "value") for place, (name, path) in enumerate(paths.items())]
    return reduce(DataFrame.unionByName, files)


def write_table(rows: DataFrame, path: str) -> None:
    """Full rebuild of a table."""
    rows.write.mode("overwrite").parquet(path)


def create_bronze(spark: SparkSession, database: str, table: str = "raw_documents") -> None:
    """Database and stored-document table, unless they exist."""
    from ..operators.staging import BRONZE

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({BRONZE}) USING parquet")


def described(rows: DataFrame) -> DataFrame:
    """col_name and data_type of a table's columns."""
    return rows.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in rows.schema], "col_name string, data_type string")
