import pytest
from pyspark.sql import functions as F

from larkspool.operators import upsert
from larkspool.streaming.ingest import ingest

ROW = "k long, v string, w string"


def rows(spark, *data):
    return spark.createDataFrame(list(data), ROW)


def test_merge_twice_is_idempotent(spark):
    target, source = rows(spark, (1, "a", "x"), (2, "b", "y")), rows(spark, (2, "B", "Y"), (3, "c", "z"))
    once = upsert.merge_actions(target, source, ["k"], ["v"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", "x", "keep"), (2, "B", "y", "update"), (3, "c", "z", "insert")]
    assert upsert.merge_receipt(once).first().asDict() == {"inserted": 1, "updated": 1, "kept": 1, "status": "inserted"}
    again = upsert.merge_actions(once.drop("action"), source, ["k"], ["v"])
    assert upsert.merge_receipt(again).first().asDict() == {"inserted": 0, "updated": 2, "kept": 1, "status": "updated"}
    assert sorted(map(tuple, again.drop("action").collect())) == sorted(map(tuple, once.drop("action").collect()))


def test_duplicate_source_keys_raise_and_dedupe_keeps_the_last(spark):
    source = rows(spark, (1, "a", "1"), (1, "b", "2"))
    with pytest.raises(ValueError, match="more than once"):
        upsert.merge_upsert(rows(spark, (9, "", "")), source, ["k"])
    assert upsert.dedupe_last(source, ["k"], ["w"]).first()["v"] == "b"


def test_watermark_is_strict_and_stale_parts_stay_unless_replaced(spark):
    kind = "chunk_id string, source_id string, ingested_at long"
    target = spark.createDataFrame([(f"d:p{i}", "d", 10) for i in range(5)] + [("e", "e", 10)], kind)
    source = spark.createDataFrame([(f"d:p{i}", "d", 11) for i in range(3)] + [("same", "s", 10)], kind)

    def merged(**more):
        t, s = (x.withColumn("ingested_at", F.timestamp_seconds("ingested_at")) for x in (target, source))
        return sorted(r["chunk_id"] for r in upsert.incremental_merge(t, s, **more).collect())

    assert merged() == ["d:p0", "d:p1", "d:p2", "d:p3", "d:p4", "e"]
    assert merged(replace_by="source_id") == ["d:p0", "d:p1", "d:p2", "e"]


def test_change_feed(spark):
    old, new = rows(spark, (1, "a", None), (2, "b", "y"), (4, "same", None)), rows(spark, (1, "A", None), (3, "c", "z"), (4, "same", None))
    got = sorted((r["change_type"], r["k"], r["v"]) for r in upsert.change_feed(old, new, "k").collect())
    assert got == [("delete", 2, "b"), ("insert", 3, "c"), ("update_postimage", 1, "A"), ("update_preimage", 1, "a")]


@pytest.mark.parametrize("now,status", [("2024-01-05", "pass"), ("2024-01-20", "warn"), ("2024-05-01", "error")])
def test_freshness(spark, now, status):
    assert upsert.freshness(spark.sql("select timestamp'2024-01-01' as ingested_at"), now).first()["status"] == status


def test_freshness_without_rows_is_an_error(spark):
    assert upsert.freshness(spark.sql("select timestamp'2024-01-01' as ingested_at").limit(0), "2024-01-01").first()["status"] == "error"


def test_batches(spark):
    def plan(sizes, budget=100, most=40):
        data = spark.createDataFrame(list(enumerate(sizes)), "i int, n int")
        return [r["batch"] for r in upsert.plan_batches(data, ["i"], F.col("n"), (), budget, most).orderBy("i").collect()]

    assert plan([10, 500, 10]) == [0, 1, 2]
    assert plan([1] * 41) == [0] * 40 + [1]
    assert plan([60, 60, 40, 1]) == [0, 1, 1, 2]
    assert plan([None, 99, 1, 1]) == [0, 0, 0, 1] and plan([]) == []
    grouped = spark.createDataFrame([(g, i, 60) for g in ("a", "b", None) for i in range(50)], "g string, i int, n int").repartition(4)
    got = {(r["g"], r["i"]): r["batch"] for r in upsert.plan_batches(grouped, ["i"], F.col("n"), ["g"], 120, 40).collect()}
    assert got == {(g, i): i // 2 for g in ("a", "b", None) for i in range(50)}


def test_payloads_are_checked(spark):
    kind = "doc_type string, source_id string, raw_text string, metadata string"
    good = spark.createDataFrame([("sorn", "a", "t", None)], kind)
    assert upsert.bronze_rows(good, "2024-01-01 00:00:00").first()["metadata"] == "{}"
    for bad in (("sorn", "", "t", None), ("other", "a", "t", None), ("sorn", "a", None, None)):
        with pytest.raises(Exception, match="payload"):
            upsert.checked_payloads(spark.createDataFrame([bad], kind)).collect()


def test_snapshots_and_streaming(spark, tmp_path):
    kind = "doc_type string, source_id string, raw_text string, metadata string"
    spark.createDataFrame([("sorn", "a", "one", None), ("sorn", "a", "two", None), ("sorn", "b", "x", None)], kind).coalesce(1).write.json(str(tmp_path / "in"))
    table = upsert.SnapshotTable(spark, f"file://{tmp_path}/bronze")
    for _ in range(2):
        query = ingest(spark.readStream.schema(kind).json(str(tmp_path / "in")), table, str(tmp_path / "ck"), lambda: "2024-01-01 00:00:00")
        assert query.awaitTermination(120)
        spark.createDataFrame([("sorn", "b", "y", None)], kind).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    assert sorted((r["source_id"], r["raw_text"]) for r in table.read().collect()) == [("a", "two"), ("b", "y")]
    versions = [v for v, _ in table.versions()]
    assert versions == [0, 1] and "_action" not in table.read().columns  # one snapshot for each merge
    changed = table.changes(versions[0], versions[-1], "source_id").collect()
    assert {r["change_type"] for r in changed} == {"update_preimage", "update_postimage"}
