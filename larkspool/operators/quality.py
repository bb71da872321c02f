"""Data tests with severities: each one is a query for failing rows, and its status comes from their number."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Test:
    """A named query for failing rows; more than ``warn_over`` of them warn, more than ``error_over`` are an error.

    ``error_over`` None: never an error.
    """

    __test__ = False

    name: str
    failing: DataFrame
    warn_over: int = 0
    error_over: int | None = 0
    rows: DataFrame | None = None
    fails: Column | None = None


def row_test(name: str, rows: DataFrame, fails: Column, warn_over: int = 0, error_over: int | None = 0) -> Test:
    """A test that tells from each row alone whether it fails; those of one table are counted in one pass over it."""
    return Test(name, rows.where(fails), warn_over, error_over, rows, fails)


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def unique(rows: DataFrame, *columns: str) -> DataFrame:
    """Values (or combinations) that several rows have; those with a null don't count for a single column."""
    some = rows.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else rows
    return some.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    return rows.where(_not_in(column, values))


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose value is in no row of ``parent``; nulls refer to nothing."""
    keys = parent.select(F.col(key).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def expression_is_true(rows: DataFrame, expression: Column | str, where: Column | str | None = None) -> DataFrame:
    """Rows for which the expression is false; null does not fail."""
    rows = rows if where is None else rows.where(where)
    return rows.where(~(F.expr(expression) if isinstance(expression, str) else expression))


def lost_documents(bronze: DataFrame, chunks: DataFrame) -> DataFrame:
    """Stored documents without a chunk."""
    keys = ["doc_type", "source_id"]
    return bronze.select(*keys).distinct().join(chunks.select(*keys).distinct(), keys, "left_anti")


def fewer_sections_than_documents(sections: DataFrame, notices: DataFrame) -> DataFrame:
    """One row with both counts if there are fewer sections than notices, else none."""
    counts = sections.agg(F.count("*").alias("section_rows")).crossJoin(notices.agg(F.count("*").alias("document_rows")))
    return counts.where("section_rows < document_rows")


def splits_without_effect(parts: DataFrame, corpus: str, keys: Sequence[str]) -> DataFrame:
    """Units that were split into one part."""
    unit = F.concat_ws("/", *(F.col(k) for k in keys)).alias("unit")
    return parts.groupBy(*keys).agg(F.max("total_parts").alias("total_parts")).where("total_parts < 2").select(F.lit(corpus).alias("corpus"), unit, "total_parts")


def uncovered_sections(chunks: DataFrame) -> DataFrame:
    """Oversized sections without parts, and parts without their section."""
    keys = ["source_id", "section_key"]

    def of(strategy: str, flag: str) -> DataFrame:
        return chunks.where(F.col("chunk_strategy") == strategy).select(*keys).distinct().withColumn(flag, F.lit(True))

    joined = of("oversized_whole", "whole").join(of("sub_split", "parts"), keys, "full_outer").where("whole is null or parts is null")
    return joined.select(*keys, F.when(F.col("parts").isNull(), "oversized section has no sub_split parts").otherwise("sub_split parts have no oversized section").alias("problem"))


def results(tests: Sequence[Test]) -> DataFrame:
    """test, failures and status (pass, warn, error) of each test."""
    passes: dict[int, list[Test]] = {}
    for i, test in enumerate(tests):
        passes.setdefault(id(test.rows) if test.rows is not None else -1 - i, []).append(test)
    counted = []
    for group in passes.values():
        if group[0].rows is None:
            counted.append(group[0].failing.agg(F.count("*").alias("failures")).select(F.lit(group[0].name).alias("test"), "failures"))
        else:
            counts = group[0].rows.agg(*(F.count_if(t.fails).alias(f"n{i}") for i, t in enumerate(group)))
            counted.append(counts.select(F.inline(F.array(*(F.struct(F.lit(t.name).alias("test"), F.col(f"n{i}").alias("failures")) for i, t in enumerate(group))))))
    n = F.col("failures")

    def over(limits: dict[str, int]) -> Column:
        known = [F.when(F.col("test") == name, F.lit(limit)) for name, limit in limits.items()]
        return n > F.coalesce(*known, F.lit(0))

    never = [t.name for t in tests if t.error_over is None]
    error = over({t.name: t.error_over for t in tests if t.error_over}) & ~F.col("test").isin(*never)
    status = F.when(error, "error").when(over({t.name: t.warn_over for t in tests if t.warn_over}), "warn").otherwise("pass")
    return reduce(DataFrame.unionByName, counted).select("test", "failures", status.alias("status"))


def _not_in(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def chunk_suite(bronze, notices, controls, sections, uses, section_parts, use_parts, control_parts, chunks, limits) -> list[Test]:
    """All tests of the stored documents, the staged rows, the parts and the chunk table."""
    longest = f"part_char_count <= {limits.longest_part}"
    tests = [row_test(f"bronze.{c}.not_null", bronze, F.col(c).isNull()) for c in ("source_id", "doc_type", "raw_text")]
    tests += [row_test("bronze.doc_type.accepted", bronze, _not_in("doc_type", ["sorn", "nist_control"]))]
    for name, rows in (("notices", notices), ("controls", controls)):
        tests += [row_test(f"{name}.source_id.not_null", rows, F.col("source_id").isNull()), Test(f"{name}.source_id.unique", unique(rows, "source_id")), row_test(f"{name}.parse_failed.accepted", rows, _not_in("parse_failed", [False]))]
    tests += [
        row_test("notices.title.not_null", notices, F.col("title").isNull(), 0, 5),
        row_test("notices.section_count.not_null", notices, F.col("section_count").isNull(), 0, None),
        row_test("notices.section_count.positive", notices, ~F.expr("section_count > 0"), 0, 3),
        row_test("controls.family_id.not_null", controls, F.col("family_id").isNull()),
        row_test("controls.is_enhancement.not_null", controls, F.col("is_enhancement").isNull(), 0, None),
        row_test("controls.parent_of_enhancement", controls, ~F.expr("not (is_enhancement and parent_control is null)")),
        row_test("sections.section_text.not_null", sections, F.col("section_text").isNull()),
        Test("sections.source_id.known", relationships(sections, "source_id", notices, "source_id")),
        row_test("uses.full_text.not_null", uses, F.col("routine_use_full_text").isNull()),
        Test("uses.source_id.known", relationships(uses, "source_id", notices, "source_id")),
    ]
    for name, rows, keys, parent in (
        ("section_parts", section_parts, ("source_id", "section_key"), notices),
        ("use_parts", use_parts, ("source_id", "routine_use_label"), notices),
        ("control_parts", control_parts, ("source_id",), controls),
    ):
        tests += [row_test(f"{name}.{c}.not_null", rows, F.col(c).isNull()) for c in ("part_text", "part_no")]
        tests += [
            Test(f"{name}.source_id.known", relationships(rows, "source_id", parent, "source_id")),
            Test(f"{name}.unique", unique(rows, *keys, "part_no")),
            row_test(f"{name}.longest", rows, ~F.expr(longest)),
            Test(f"{name}.effect", splits_without_effect(rows, name, keys)),
        ]
    tests += [row_test(f"chunks.{c}.not_null", chunks, F.col(c).isNull()) for c in ("chunk_id", "chunk_text", "doc_type", "chunk_strategy")]
    tests += [
        Test("chunks.chunk_id.unique", unique(chunks, "chunk_id")),
        row_test("chunks.doc_type.accepted", chunks, _not_in("doc_type", ["sorn", "nist_control"])),
        row_test("chunks.chunk_type.accepted", chunks, _not_in("chunk_type", ["section", "routine_use", "control", "control_enhancement"])),
        row_test("chunks.chunk_strategy.accepted", chunks, _not_in("chunk_strategy", ["standard", "oversized_whole", "sub_split"])),
        row_test("chunks.shortest", chunks, ~F.expr("chunk_char_count >= 50"), 0, 25),
        row_test("chunks.ceiling", chunks, F.expr("chunk_strategy != 'oversized_whole'") & ~F.expr(f"chunk_char_count <= {limits.ceiling}")),
        Test("lost_documents", lost_documents(bronze, chunks)),
        Test("fewer_sections_than_documents", fewer_sections_than_documents(sections, notices)),
        Test("uncovered_sections", uncovered_sections(chunks)),
    ]
    return tests
