"""Queries that SQL can express, against it; and the columns and rows that the others promise."""

import os

import duckdb
import pytest

from larkspool.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
PROMISED = {
    "op1": {"page_id", "url", "text", "n_chars"},
    "op2": {"doc_id", "held_out", "score", "predicted"},
    "op3": {"doc_id", "item_ids"},
    "op4": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op5": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op6": {"doc_id", "held_out", "score", "predicted"},
    "op7": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op8": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op9": {"doc_id", "held_out", "lang_pred", "score"},
    "op10": {"doc_id", "n_shingles", "component_id"},
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_promised_columns(spark, name):
    got = QUERIES[name](spark, SF)
    assert PROMISED[name.split("_")[0]] <= set(got.columns)
    if not name.startswith("op3"):
        source, key = ("pages", "page_id") if name.startswith("op1_") else ("documents", "doc_id")
        assert got.select(key).exceptAll(spark.read.parquet(f"{SF}/{source}.parquet").select(key)).count() == 0
