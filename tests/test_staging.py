import json

import pytest
from pyspark.sql import functions as F

from larkspool.functions.text import Limits
from larkspool.operators import gold, quality, staging


def bronze(spark, *rows):
    """rows: (doc_type, source_id, raw_text, metadata)."""
    return spark.createDataFrame([(f"i{i}", *r, None) for i, r in enumerate(rows)], staging.BRONZE).withColumn("ingested_at", F.timestamp_seconds(F.lit(0)))


@pytest.mark.parametrize("text,bad", [(None, True), ("", True), ("{bad", True), ("[]", True), ('"x"', True), ("null", True), ("{}", False), ('{"a":1}', False)])
def test_parse_failed(spark, text, bad):
    row = staging.stage_notices(bronze(spark, ("sorn", "a", "t", text))).first()
    assert row["parse_failed"] is bad


def test_objects_are_told_without_a_schema(spark):
    """One pass over the JSON, no schema made from it, with the same answers."""
    texts = [' \t\r\n{"a": 1}', "{", '{"a":1,"a":2}', "{} x", "[{}]", "\ufeff{}", "\u00a0{}", "{}", "1", "true", " ", '{"a":{"b":[1,{"c":null}]}}', None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    old = ~F.coalesce(F.schema_of_variant(F.try_parse_json("t")).startswith("OBJECT"), F.lit(False))
    new = rows.select("t", staging.is_unparsed(F.col("t")).alias("bad"))
    assert sorted(map(repr, new.collect())) == sorted(map(repr, rows.select("t", old.alias("bad")).collect()))
    assert "schema_of_variant" not in new._jdf.queryExecution().analyzed().toString().lower()


def notice(title="T", sections=(), uses=()):
    return json.dumps({"title": title, "agency": None, "sections": list(sections), "routine_uses": list(uses)})


def test_empty_and_null_arrays_give_no_rows(spark):
    rows = staging.stage_notices(bronze(spark, ("sorn", "a", "t", notice()), ("sorn", "b", "t", "{}")))
    assert staging.sections(rows).count() == 0 and staging.routine_uses(rows).count() == 0


def test_folded_subitems_appear_twice_unless_told_otherwise(spark):
    use = {"label": "A", "text": "To: 1. x; 2. y", "subitems": [{"label": "1", "text": "x;"}, {"label": "2", "text": "y"}]}
    rows = staging.stage_notices(bronze(spark, ("sorn", "a", "t", notice(uses=[use]))))
    assert staging.routine_uses(rows).first()["routine_use_full_text"] == "To: 1. x; 2. y\n1 x;\n2 y"
    assert staging.routine_uses(rows, repeat_subitems=False).first()["routine_use_full_text"] == "To: 1. x; 2. y"


def made(spark, body, title="T"):
    meta = notice(title, [{"section_key": "purpose", "heading": "P", "ordinal": 0, "text": body}, {"section_key": "routine_uses", "heading": "R", "ordinal": 1, "text": body}])
    stored = bronze(spark, ("sorn", "a", body, meta), ("nist_control", "AC-1", body, json.dumps({"title": "C", "is_enhancement": True, "baselines": ["low"]})))
    n, c = staging.stage_notices(stored), staging.stage_controls(stored)
    s, u = staging.sections(n), staging.routine_uses(n)
    return stored, n, c, s, u, gold.document_chunks(s, u, c)


def test_short_texts_are_one_chunk_in_both_arms(spark):
    *_, chunks = made(spark, "Short text. " * 5)
    rows = {r["chunk_id"]: r for r in chunks.collect()}
    assert set(rows) == {"sorn:a:sec:purpose", "nist:AC-1"}
    assert rows["nist:AC-1"]["chunk_type"] == "control_enhancement" and rows["nist:AC-1"]["section_key"] is None
    assert gold.arm(chunks, "whole").count() == gold.arm(chunks, "split").count() == 2


def test_long_texts_and_the_suite(spark):
    stored, n, c, s, u, chunks = made(spark, "A sentence here. " * 200)
    kinds = {(r["chunk_type"], r["chunk_strategy"]): r["count"] for r in chunks.groupBy("chunk_type", "chunk_strategy").count().collect()}
    assert kinds == {("section", "oversized_whole"): 1, ("section", "sub_split"): 3, ("control_enhancement", "standard"): 3}
    label = chunks.where("chunk_id = 'sorn:a:sec:purpose:p1'").first()["chunk_label"]
    assert label == "P (part 2 of 3)"
    parts = gold.split_sections(s), gold.split_routine_uses(u), gold.split_controls(c)
    got = {r["test"]: (r["failures"], r["status"]) for r in quality.results(quality.chunk_suite(stored, n, c, s, u, *parts, chunks, Limits())).collect()}
    failing = {k for k, v in got.items() if v[1] != "pass"}
    assert failing == {"notices.section_count.not_null", "controls.family_id.not_null", "controls.parent_of_enhancement"}
    assert got["notices.section_count.not_null"] == (1, "warn") and got["controls.family_id.not_null"] == (1, "error")
    assert got["lost_documents"] == (0, "pass") and len(got) > 40


def test_oversized_by_its_title_only_fails_the_effect_test(spark):
    _, _, _, s, _, chunks = made(spark, "word " * 220, title="T" * 1000)
    assert quality.splits_without_effect(gold.split_sections(s), "sections", ["source_id", "section_key"]).count() == 1


def test_thresholds_and_singular_tests(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (2, "y")], "a int, b string")
    tests = [
        quality.Test("warn", quality.not_null(rows, "b"), 0, 5),
        quality.Test("error", quality.unique(rows, "a")),
        quality.Test("null does not fail", quality.expression_is_true(rows, "b = b")),
        quality.Test("never an error", quality.accepted_values(rows, "b", ["x"]), 0, None),
    ]
    assert [r["status"] for r in quality.results(tests).collect()] == ["warn", "error", "pass", "warn"]
    assert quality.relationships(rows, "b", rows.where("a = 1"), "b").count() == 2
    assert quality.fewer_sections_than_documents(rows.limit(1), rows).first().asDict() == {"section_rows": 1, "document_rows": 3}
