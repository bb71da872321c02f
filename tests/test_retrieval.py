import math

import pytest
from pyspark.sql import functions as F

from larkspool.operators import retrieval as R


def corpus(spark, texts, arms=("whole",)):
    return spark.createDataFrame([(a, f"d{i}", t) for a in arms for i, t in enumerate(texts)], "arm string, doc string, text string")


def test_repeated_query_terms_count_twice_and_ties_go_by_doc(spark):
    docs = corpus(spark, ["a b", "a b", "c", ""])
    once = R.bm25(docs, spark.createDataFrame([(1, "a")], "query_id int, question string")).orderBy("rank").collect()
    twice = R.bm25(docs, spark.createDataFrame([(1, "a a zzz")], "query_id int, question string")).orderBy("rank").collect()
    assert [r["doc"] for r in once] == ["d0", "d1"]
    assert twice[0]["score"] == pytest.approx(2 * once[0]["score"], abs=2e-6)
    mean = 5 / 4
    norm = 1 - 0.75 + 0.75 * 2 / mean
    assert once[0]["score"] == pytest.approx(math.log(1 + 2.5 / 2.5) * 2.5 / (1 + 1.5 * norm), abs=1e-6)


def test_metrics(spark):
    kind = "arm string, query_id int, rank int, source_id string, section_key string"
    found = [("split", 1, r, "a", "p") for r in (1, 2, 3)] + [("whole", 1, 1, "x", "p"), ("whole", 1, 2, "a", "p"), ("whole", 2, 4, "n", None)]
    targets = spark.createDataFrame([(1, "a", "p"), (1, "b", "q"), (2, "n", None)], "query_id int, source_id string, section_key string")
    queries = spark.createDataFrame([(1, "contested"), (2, "control"), (3, "control")], "query_id int, class string")
    scores = R.metrics(spark.createDataFrame(found, kind), targets, queries)
    got = {(r["arm"], r["query_id"]): r for r in scores.collect()}
    ideal = 1 + 1 / math.log2(3)
    # one target three times is one gain; a null section key equals a null section key
    assert got["split", 1]["ndcg"] == pytest.approx(1 / ideal) and got["split", 1]["recall"] == 0.5
    assert got["whole", 1]["mrr"] == 0.5 and got["whole", 2]["mrr"] == 0.25 and got["whole", 2]["hit"] == 1
    assert got["split", 2]["hit"] == 0 and [got["whole", 3][m] for m in R.METRICS] == [0, 0, 0, 0]
    report = {(r["class"], r["metric"]): r for r in R.comparison(scores).collect()}
    assert report["contested", "mrr"]["trend"] == "+" and report["all", "hit"]["n"] == 3
    assert R.crowding(scores).first().asDict() == {"moved": 1, "n_control": 2}


def test_structural_problems(spark):
    kind = "chunk_id string, chunk_strategy string, chunk_text string"
    chunks = spark.createDataFrame([("a", "standard", "x"), ("w", "oversized_whole", "y"), ("s", "sub_split", "z")], kind)
    a, b = chunks.where("chunk_strategy != 'sub_split'"), chunks.where("chunk_strategy != 'oversized_whole'")
    assert [r["n"] for r in R.structural_problems(chunks, a, b).collect()] == [0] * 5
    assert [r["n"] for r in R.structural_problems(chunks, a.where("chunk_id <> 'a'"), chunks.withColumn("chunk_text", F.lit("?"))).collect()] == [1, 0, 1, 0, 1]


def test_dense_search(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, [2.0, 0.0]), (6, None), (7, [1.0])], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(9, [1.0, 0.0])], "query_id long, embedding array<float>")
    assert [(r["vec_id"], r["score"]) for r in R.dense_search(rows, queries, 3).orderBy("rank").collect()] == [(1, 1.0), (5, 1.0), (2, 0.707107)]
    assert R.dense_search(rows, queries, 3, F.col("vec_id") > 2).orderBy("rank").first()["vec_id"] == 5
    assert R.dense_search(rows, queries.limit(0), 3).count() == 0


def test_dense_search_in_blocks(spark, monkeypatch):
    import numpy as np

    r = np.random.default_rng(3)
    x = r.normal(size=(300, 8)).round(3)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, [None] * 8), (901, [1.0])], "vec_id long, embedding array<double>").repartition(5)
    # the commonest length of the queries counts, whichever comes first
    queries = spark.createDataFrame([(5000, [1.0, 2.0])] + [(1000 + i, v.tolist()) for i, v in enumerate(x[:23])], "query_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = np.round(unit[:23] @ unit.T, 6)
    want = sorted((1000 + i, int(j), k + 1) for i in range(23) for k, j in enumerate(np.lexsort((np.arange(300), -scores[i]))[:4]))
    for block, batch in ((2000, 2000), (7, 13)):
        monkeypatch.setattr(R, "QUERY_BLOCK", block)
        monkeypatch.setattr(R, "ROW_BLOCK", batch)
        assert sorted((a["query_id"], a["vec_id"], a["rank"]) for a in R.dense_search(rows, queries, 4).collect()) == want


@pytest.mark.parametrize("bound", ["MOST_TERMS", "MOST_TARGETS"])
def test_shuffled_joins_give_the_same(spark, monkeypatch, bound):
    docs = corpus(spark, [f"w{i % 3} w{i % 5} w{i % 7}" for i in range(40)], ("whole", "split"))
    queries = spark.createDataFrame([(1, "w0 w1"), (2, "w6 w6 none"), (3, "")], "query_id int, question string")
    targets = spark.createDataFrame([(1, "d0", "p")], "query_id int, source_id string, section_key string")

    def scores():
        found = R.bm25(docs, queries).withColumns({"source_id": F.col("doc"), "section_key": F.lit("p")})
        return sorted(map(tuple, found.collect())), sorted(map(tuple, R.metrics(found, targets, queries.select("query_id")).collect()))

    want = scores()
    monkeypatch.setattr(R, bound, 0)
    assert want == scores() and len(want[0]) == 20


def test_scores_are_added_up_where_a_document_is(spark):
    """Between the postings and the best of each task, scores are not shuffled."""
    docs = corpus(spark, ["a b", "b c", "c d"])
    plan = R.bm25(docs, spark.createDataFrame([(1, "a b c")], "query_id int, question string"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Exchange hashpartitioning(arm") == 2  # by document, then the best by query


def brute_bm25(rows, questions, k):
    """(arm, query_id, doc, score, rank) of rows(arms, doc, text), step by step."""
    import re
    from collections import Counter, defaultdict

    out = []
    for arm in ("whole", "split"):
        mine = [(d, re.findall("[a-z0-9]+", (t or "").lower())) for arms, d, t in rows if arm in arms]
        mean = sum(len(w) for _, w in mine) / len(mine)
        posts = defaultdict(Counter)
        for d, w in mine:
            posts[d, len(w)].update(w)
        df = Counter(t for c in posts.values() for t in c)
        for q, text in questions:
            scores = defaultdict(float)
            for term, times in Counter(re.findall("[a-z0-9]+", text.lower())).items():
                for (d, n), c in posts.items():
                    if c[term]:
                        idf = math.log(1 + (len(mine) - df[term] + 0.5) / (df[term] + 0.5))
                        scores[d] += times * idf * c[term] * 2.5 / (c[term] + 1.5 * (1 - 0.75 + 0.75 * n / mean))
            out += [(arm, q, d, -s, i + 1) for i, (s, d) in enumerate(sorted((-round(s, 6), d) for d, s in scores.items())[:k])]
    return sorted(out)


def test_scoring_gives_no_row_for_each_posting_and_query(spark, monkeypatch):
    """Documents are scored where they are: only shared documents are joined with the queries' weights, also in small blocks, with equal and shared documents."""
    import random

    r = random.Random(5)
    rows = [(["whole", "split"], f"d{i}", " ".join(f"W{r.randint(0, 9)}" for _ in range(r.randint(0, 12)))) for i in range(60)]
    rows += [(["split"], f"s{i}", "w1 w2 w2") for i in range(20)] + [(["whole"], "n", None)]
    # documents that several rows share, of one length and of others, in one arm and in both
    rows += [(["whole", "split"], "d3", "w1 w1"), (["whole", "split"], "d3", "w1 w4"), (["split"], "s2", "w7 w2 w0"), (["split"], "s2", "w1")]
    questions = [(i, " ".join(f"w{r.randint(0, 12)}" for _ in range(r.randint(1, 6)))) for i in range(9)]
    docs = spark.createDataFrame(rows, "arms array<string>, doc string, text string").repartition(3)
    asked = spark.createDataFrame(questions, "query_id int, question string")
    want = brute_bm25(rows, questions, 4)
    for block, cells in ((2_000, 4_000_000), (7, 40)):
        monkeypatch.setattr(R, "ROW_BLOCK", block)
        monkeypatch.setattr(R, "COUNT_BLOCK", block)
        monkeypatch.setattr(R, "CELLS", cells)
        found = R.bm25(docs, asked, 4)
        assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
        got = sorted((a["arm"], a["query_id"], a["doc"], a["score"], a["rank"]) for a in found.collect())
        assert [x[:3] + x[4:] for x in got] == [x[:3] + x[4:] for x in want]
        assert [x[3] for x in got] == pytest.approx([x[3] for x in want], abs=2e-6)
