"""From stored JSON documents to typed rows: notices with their sections and routine uses, and controls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import non_blank, size_or_zero

BRONZE = "ingestion_id string, doc_type string, source_id string, raw_text string, metadata string, ingested_at timestamp"
BRONZE_KEY = ("doc_type", "source_id")
DOC_TYPES = ("sorn", "nist_control")

#: The metadata of a notice and of a control, as they are stored.
NOTICE_METADATA = (
    "title string, system_number string, agency string, component string, source_url string, source_file string, docket_number string, "
    "fr_doc_number string, fr_volume bigint, fr_number bigint, fr_pages string, fr_publication_date string, effective_date string, "
    "action_raw string, action_type string, agency_line string, summary string, dates_raw string, contact_raw string, "
    "security_classification string, fr_citations array<string>, page_markers array<string>, format_variant string, "
    "content_sha256 string, char_count bigint, parser_version string, parse_status string, quality_flags array<string>, "
    "missing_sections array<string>, section_count bigint, routine_use_count bigint, "
    "sections array<struct<section_key: string, heading: string, ordinal: bigint, text: string, char_count: bigint>>, "
    "routine_uses array<struct<label: string, text: string, char_count: bigint, subitems: array<struct<label: string, text: string>>>>"
)
CONTROL_METADATA = (
    "title string, control_id string, family_id string, family string, is_enhancement boolean, parent_control string, "
    "related_controls array<string>, baselines array<string>, source string, source_url string, char_count bigint"
)
NOTICE_COLUMNS = (
    "title system_number agency component source_url docket_number fr_doc_number fr_publication_date effective_date action_type summary "
    "security_classification format_variant content_sha256 parser_version parse_status quality_flags missing_sections section_count "
    "routine_use_count sections routine_uses"
).split()
CONTROL_COLUMNS = "title control_id family_id family is_enhancement parent_control related_controls baselines source source_url".split()
BASELINES = ("low", "moderate", "high")


def is_unparsed(metadata: Column) -> Column:
    """Not a JSON object: null, empty, malformed, an array, a scalar and JSON null.

    ``from_json`` can't tell: it gives a struct of nulls for most of these.
    """
    # JSON that begins with a brace is an object
    return ~F.coalesce(F.try_parse_json(metadata).isNotNull() & F.ltrim(metadata, F.lit(" \t\r\n")).startswith("{"), F.lit(False))


def _staged(bronze: DataFrame, doc_type: str, schema: str, columns: list[str]) -> DataFrame:
    rows = bronze.where(F.col("doc_type") == doc_type)
    rows = rows.select("ingestion_id", "source_id", "raw_text", "ingested_at", F.from_json("metadata", schema).alias("m"), is_unparsed(F.col("metadata")).alias("parse_failed"))
    return rows.select("ingestion_id", "source_id", "raw_text", "ingested_at", *(F.col(f"m.{c}").alias(c) for c in columns), "parse_failed")


def stage_notices(bronze: DataFrame) -> DataFrame:
    """Typed notices, one row for each stored one."""
    return _staged(bronze, "sorn", NOTICE_METADATA, NOTICE_COLUMNS)


def stage_controls(bronze: DataFrame) -> DataFrame:
    """Typed controls with a flag for each baseline (null where the baselines are unknown)."""
    staged = _staged(bronze, "nist_control", CONTROL_METADATA, CONTROL_COLUMNS)
    return staged.withColumns({f"in_{b}_baseline": F.array_contains("baselines", b) for b in BASELINES})


def sections(notices: DataFrame) -> DataFrame:
    """One row for each section with text."""
    rows = notices.where(~F.col("parse_failed")).select("*", F.explode("sections").alias("s"))
    return rows.where(non_blank(F.col("s.text"))).select(
        "source_id", F.col("title").alias("document_title"), "agency", "component", "system_number", "effective_date", "source_url", "content_sha256",
        F.col("s.section_key").alias("section_key"), F.col("s.heading").alias("heading"), F.col("s.ordinal").alias("section_ordinal"),
        F.col("s.text").alias("section_text"), F.col("s.char_count").alias("section_char_count"), "ingested_at",
    )


def folded_text(item: Column, repeat_subitems: bool = True) -> Column:
    """An item's text with its numbered sub-items on lines of their own below it.

    The item's text already holds them, so they are repeated; without ``repeat_subitems`` the text stays as it is.
    """
    lines = F.array_join(F.transform(item["subitems"], lambda x: F.concat(x["label"], F.lit(" "), x["text"])), "\n")
    return F.when((size_or_zero(item["subitems"]) > 0) & F.lit(repeat_subitems), F.concat(item["text"], F.lit("\n"), lines)).otherwise(item["text"])


def routine_uses(notices: DataFrame, repeat_subitems: bool = True) -> DataFrame:
    """One row for each routine use with text."""
    rows = notices.where(~F.col("parse_failed")).select("*", F.explode("routine_uses").alias("u"))
    return rows.where(non_blank(F.col("u.text"))).select(
        "source_id", F.col("title").alias("document_title"), "agency", "system_number", "effective_date", "source_url", "content_sha256",
        F.col("u.label").alias("routine_use_label"), F.col("u.text").alias("routine_use_text"), F.col("u.char_count").alias("routine_use_char_count"),
        folded_text(F.col("u"), repeat_subitems).alias("routine_use_full_text"), size_or_zero(F.col("u.subitems")).alias("subitem_count"), "ingested_at",
    )


def inferred_schemas(documents: DataFrame, column: str = "metadata") -> DataFrame:
    """schema and n: the schemas of the stored JSON documents and how many rows have each; rows that are none are left out."""
    known = documents.where(~is_unparsed(F.col(column))).select(F.schema_of_variant(F.try_parse_json(column)).alias("schema"))
    return known.groupBy("schema").agg(F.count("*").alias("n"))
