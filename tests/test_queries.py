"""Every query of the engine against its SQL on the smallest test data, and the driver's contract."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from larkspool.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in result.fetchall())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["chunk_strategy"] for r in rows} == {"standard", "oversized_whole", "sub_split"}
    assert set(ORACLES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_splitting_and_staging_do_not_shuffle(spark):
    for name in ("split_parts", "explode_sections", "baseline_flags", "tokenize"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        if name != "explode_sections":  # conversations are gathered from their turns first
            assert "Exchange" not in plan or name == "baseline_flags", plan
        assert "Python" not in plan
