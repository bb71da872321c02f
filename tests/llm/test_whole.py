"""Rows and tables of which earlier versions did only a part."""

import numpy as np
import pytest

from larkspool.llm import decontaminate, license_scan, toxicity
from tests.llm.test_models import table

BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
CC = "This work is licensed under a Creative Commons Attribution licence"


@pytest.mark.parametrize("n,every", [(60, 3), (60, 1), (1, 1), (5, 5)])
def test_common_licence_words_are_looked_up(spark, n, every):
    rows = [(i, f"row {i} {BSD if i % 2 else CC} end" if i % every == 0 else f"row {i} of other words") for i in range(n)]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(table(spark, rows)).collect()}
    assert got == {i: (("bsd" if i % 2 else "cc") if i % every == 0 else "", pytest.approx(1.0 if i % every == 0 else 0.0)) for i in range(n)}


def test_verbatim_passages_without_a_template(spark):
    texts = {1: "12 + 7 - 3 * 4 = 16", 2: "What is 3 + 4", 3: "Alice Bob Carol Dora Emil Fritz Gerda Hans Ida Jan", 4: "5 min in 7 s", 5: "1 22 333 4444 55555 1 22 333 4444 1 2", 6: "42", 7: "?!", 8: "Boston is the largest city in this state"}
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    rows = [(10 + i, f"so that {t}. Then more") for i, t in texts.items()]
    rows += [(30, "12 + 7 - 3 * 4 = 17"), (31, "What is 3 + 5"), (32, "142 and 420"), (33, "Alice Bob Dora Carol Emil Gerda Fritz Hans Jan Ida"), (34, "what is 3 plus 4")]
    got = {r["doc_id"]: (r["item_ids"], r["reparameterised"]) for r in decontaminate.contaminated(table(spark, rows), items).collect()}
    assert got == {10 + i: ([i], False) for i in texts if i != 7}


def test_values_are_exchanged_consistently_over_a_whole_copy(spark):
    question = "A train leaves Boston at 5 pm and travels 60 miles per hour for 3 hours until Boston is far away"
    items = spark.createDataFrame([(1, question)], "item_id long, text string")
    swap = lambda **by: " ".join(by.get(f"w{w}", w) for w in question.split())
    broken = question.replace("Boston at", "Denver at").replace("5 pm and travels 60 miles per hour for 3", "7 pm and travels 60 miles per hour for 9")
    changed, merged = swap(wBoston="Denver", w60="75"), swap(w5="4", w3="4")
    close = "we saw that 5 plus 3 is what we need now"
    items = items.union(spark.createDataFrame([(2, close)], "item_id long, text string"))
    rows = [(15, broken), (16, changed), (17, merged), (18, f"{changed}. So {swap(wBoston='Austin')}."), (19, close.replace("5", "4").replace("3", "4")), (20, f"{broken}. {question}")]
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.contaminated(table(spark, rows), items).collect()}
    assert got == {16: [1], 17: [1], 18: [1], 19: [2], 20: [1]}


def test_toxic_sequences_of_late_documents_train_the_field(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SEQUENCES", 60)
    clean = [f"plain words here {i} nothing and some more of them follow now" for i in range(200)]
    toxic = [f"plain {w} words {i} here nothing and some more of them follow now" for w in ("nasty", "vile") for i in range(100)]
    field = toxicity.fit(clean + toxic, np.array([0] * 200 + [1] * 200), np.ones(400))
    rows = [(1, "plain nasty words here nothing"), (2, "plain vile words here nothing"), (3, "plain words here nothing")]
    got = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in toxicity.score_documents(table(spark, rows), field).collect()}
    assert got == {1: [(6, 11)], 2: [(6, 10)], 3: []}
