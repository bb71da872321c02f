"""Queries of which earlier versions did only a part."""

import os

import pytest

from larkspool.functions.text import Limits
from larkspool.operators import gold, quality
from larkspool.plans.catalog import QUERIES
from larkspool.plans.corpus import chunks, staged

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_routine_uses_and_controls_are_indexed_in_both_arms(spark):
    found = QUERIES["bm25_postings"](spark, SF).select("arm", "doc").distinct().collect()
    of = {arm: {r["doc"] for r in found if r["arm"] == arm} for arm in ("whole", "split")}
    uses, controls = ({d for d in of["whole"] if ":ru:" in d}, {d for d in of["whole"] if d.startswith("nist:")})
    assert uses and controls
    assert uses | controls == {d for d in of["split"] if ":ru:" in d or d.startswith("nist:")}


def test_the_suite_reports_null_texts_and_repeated_documents(spark, tmp_path):
    long = "A sentence of some words here. " * 100
    docs = [(1, long, "en", "web"), (2, None, "de", "web"), (3, "short", "fr", "web"), (3, "short", "fr", "web"), (4, "word " * 330, "en", "web")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"file://{tmp_path}/documents.parquet")
    turns = [(1, 0, "user", "A question of some length that is asked here"), (1, 1, "bot", long)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    got = {r["test"]: (r["failures"], r["status"]) for r in QUERIES["dq_suite"](spark, f"file://{tmp_path}").collect()}
    s = staged(spark, f"file://{tmp_path}")
    parts = gold.split_sections(s["sections"]), gold.split_routine_uses(s["uses"]), gold.split_controls(s["controls"])
    suite = quality.chunk_suite(s["bronze"], s["notices"], s["controls"], s["sections"], s["uses"], *parts, chunks(spark, f"file://{tmp_path}"), Limits())
    assert len(got) == len(suite) > 50
    assert {k: n for k, (n, _) in got.items()} == {t.name: len(t.failing.collect()) for t in suite}
    # one text is null as a notice and as a control; one doc_id is there twice
    assert got["bronze.raw_text.not_null"] == (2, "error")
    assert got["controls.source_id.unique"][0] == got["notices.source_id.unique"][0] == 1 and got["chunks.chunk_id.unique"] == (2, "error")
    assert got["lost_documents"] == (2, "error")
