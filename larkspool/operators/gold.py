"""The chunk table: sections, routine uses and controls as one, whole or split, tagged for the two arms of a comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import Limits, chunk_text, is_indexable, is_oversized, non_blank, part_label
from .split import split_parts

#: Columns of the chunk table and their types; a branch that lacks one gets a typed null.
COLUMNS = {
    "chunk_id": "string", "doc_type": "string", "chunk_type": "string", "chunk_strategy": "string", "source_id": "string", "section_key": "string",
    "document_title": "string", "chunk_text": "string", "chunk_label": "string", "ordinal": "bigint", "agency": "string", "system_number": "string",
    "effective_date": "string", "source_url": "string", "family": "string", "baselines": "array<string>", "content_sha256": "string", "ingested_at": "timestamp",
}
STANDARD, WHOLE, SPLIT = "standard", "oversized_whole", "sub_split"
#: The strategy that each arm leaves out.
ARMS = {"whole": SPLIT, "split": WHOLE}
_CARRIED = ("document_title", "agency", "system_number", "effective_date", "source_url", "content_sha256", "ingested_at")


def _oversized(heading: Column, body: str, limits: Limits) -> Column:
    return is_oversized(F.col("document_title"), F.col("agency"), heading, F.col(body), limits)


def _use_label() -> Column:
    return F.concat(F.lit("Routine Use "), F.col("routine_use_label"))


def split_sections(sections: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Parts of the sections that are indexed and too long, with the sections' columns."""
    return split_parts(sections, ("source_id", "section_key"), "section_text", is_indexable(F.col("section_key")) & _oversized(F.col("heading"), "section_text", limits), limits, ("heading", "section_ordinal", *_CARRIED))


def split_routine_uses(uses: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return split_parts(uses, ("source_id", "routine_use_label"), "routine_use_full_text", _oversized(_use_label(), "routine_use_full_text", limits), limits, _CARRIED)


def split_controls(controls: DataFrame, limits: Limits = Limits()) -> DataFrame:
    return split_parts(controls, ("source_id",), "raw_text", ~F.col("parse_failed") & (F.length("raw_text") > limits.ceiling), limits, ("title", "family", "baselines", "is_enhancement", "source_url", "ingested_at"))


def _row(rows: DataFrame, **values: Column | str) -> DataFrame:
    given = {k: F.lit(v) if isinstance(v, str) else v for k, v in values.items()}
    named = {c: given.get(c, F.col(c) if c in rows.columns else F.lit(None)) for c in COLUMNS}
    return rows.select(*(named[c].cast(kind).alias(c) for c, kind in COLUMNS.items()))


def document_chunks(sections: DataFrame, uses: DataFrame, controls: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All chunks with ``chunk_char_count``.

    A section over the ceiling is there twice: whole, for arm ``whole``, and in parts, for arm ``split``.  Other long texts
    are only there in parts, which both arms have.
    """
    col = F.col

    def text(heading: Column, body: str) -> Column:
        return chunk_text(col("document_title"), col("agency"), heading, col(body))

    whole = sections.where(is_indexable(col("section_key")))
    parts = split_sections(sections, limits)
    use_parts, control_parts = split_routine_uses(uses, limits), split_controls(controls, limits)
    label = part_label(col("heading"), col("part_no"), col("total_parts"))
    use_label = part_label(_use_label(), col("part_no"), col("total_parts"))
    control_label = F.concat(col("source_id"), F.lit(" "), col("title"))
    control_part = part_label(control_label, col("part_no"), col("total_parts"))
    kind = F.when(col("is_enhancement"), "control_enhancement").otherwise("control")
    section_id = F.concat(F.lit("sorn:"), col("source_id"), F.lit(":sec:"), col("section_key"))
    use_id = F.concat(F.lit("sorn:"), col("source_id"), F.lit(":ru:"), col("routine_use_label"))
    control_id = F.concat(F.lit("nist:"), col("source_id"))
    nth = F.concat(F.lit(":p"), col("part_no").cast("string"))
    branches = [
        _row(whole, chunk_id=section_id, doc_type="sorn", chunk_type="section", chunk_strategy=F.when(_oversized(col("heading"), "section_text", limits), WHOLE).otherwise(STANDARD),
             chunk_text=text(col("heading"), "section_text"), chunk_label=col("heading"), ordinal=col("section_ordinal")),
        _row(parts, chunk_id=F.concat(section_id, nth), doc_type="sorn", chunk_type="section", chunk_strategy=SPLIT, chunk_text=text(label, "part_text"), chunk_label=label, ordinal=col("section_ordinal")),
        _row(uses.where(~_oversized(_use_label(), "routine_use_full_text", limits)), chunk_id=use_id, doc_type="sorn", chunk_type="routine_use", chunk_strategy=STANDARD, section_key="routine_uses",
             chunk_text=text(_use_label(), "routine_use_full_text"), chunk_label=_use_label()),
        _row(use_parts, chunk_id=F.concat(use_id, nth), doc_type="sorn", chunk_type="routine_use", chunk_strategy=STANDARD, section_key="routine_uses", chunk_text=text(use_label, "part_text"), chunk_label=use_label),
        _row(controls.where(~col("parse_failed") & (F.length("raw_text") <= limits.ceiling)), chunk_id=control_id, doc_type="nist_control", chunk_type=kind, chunk_strategy=STANDARD,
             document_title=col("title"), chunk_text=col("raw_text"), chunk_label=control_label),
        _row(control_parts, chunk_id=F.concat(control_id, nth), doc_type="nist_control", chunk_type=kind, chunk_strategy=STANDARD, document_title=col("title"),
             chunk_text=F.concat_ws("\n\n", control_part, col("part_text")), chunk_label=control_part),
    ]
    chunks = reduce(DataFrame.unionByName, branches)
    return chunks.where(non_blank(col("chunk_text"))).withColumn("chunk_char_count", F.length("chunk_text"))


def arm(chunks: DataFrame, name: str) -> DataFrame:
    """The chunks of arm ``whole`` or ``split``."""
    return chunks.where(F.col("chunk_strategy") != ARMS[name])


def strategy_counts(chunks: DataFrame) -> DataFrame:
    """Chunks for each strategy, with the longest and the mean length."""
    return chunks.groupBy("chunk_strategy").agg(
        F.count("*").alias("n_chunks"), F.max("chunk_char_count").alias("longest"), F.round(F.avg("chunk_char_count"), 6).alias("mean_chars")
    )
