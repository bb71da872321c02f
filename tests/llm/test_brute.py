"""Learned operators against plain loops, and the odd rows and tables that no other test holds."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from larkspool.llm import byte_bpe, exact_dedup, jaccard_join, kernels as K, language_id, quality, substring_dedup, toxicity
from larkspool.llm.scratch import prepare
from tests.llm.test_models import ODD, table

LONG = " ".join(f"w{i % 7919}" for i in range(60_000))


def test_token_labels_and_scores_by_loops():
    r = random.Random(3)
    plain = [f"word{i}" for i in range(40)]
    texts, label = [], []
    for i in range(200):
        w = [r.choice(plain) for _ in range(r.randrange(5, 60))]
        label.append(int(i % 3 == 0))
        if label[-1] and r.random() < 0.9:
            w[r.randrange(len(w))] = r.choice(("vilest", "nasty"))
        texts.append(" ".join(w))
    label = np.array(label)
    w = K.words(*K.buffers(pa.array(texts)), toxicity.IN_WORD)
    feature = toxicity.features(w)
    got = toxicity.token_labels(feature, w.doc, label)
    toxic, clean = defaultdict(set), defaultdict(set)
    for f, d in zip(feature.tolist(), w.doc.tolist()):
        for k, x in enumerate(f):
            if x != toxicity.FEATURES - 1:
                (toxic if label[d] else clean)[k, x].add(d)
    a, b = int(label.sum()), int(len(label) - label.sum())
    sign = {}
    for key in toxic:
        t, c = len(toxic[key]), len(clean[key])
        q, base = min(max(t / (t + c), 1e-9), 1 - 1e-9), a / (a + b)
        if math.log((t + 0.05) / a) - math.log((c + 0.5) / b) > 2.5 and t * math.log(q / base) + c * math.log((1 - q) / (1 - base)) > toxicity.SURPRISE:
            sign[key] = t * math.log(q / base) + c * math.log((1 - q) / (1 - base))
    each = [max((sign.get((k, x), 0.0) for k, x in enumerate(f)), default=0.0) for f in feature.tolist()]
    surest = defaultdict(float)
    for d, s in zip(w.doc.tolist(), each):
        surest[d] = max(surest[d], s)
    want = [s > 0 and s >= toxicity.EXPLAINED * surest[d] and label[d] == 1 for d, s in zip(w.doc.tolist(), each)]
    assert got.tolist() == want and sum(want) > 40

    field = toxicity.fit(texts, label, np.ones(len(label)))
    p = field.tag(w)
    scores = field.scores(w, p)
    for d in range(0, 200, 17):
        mine = p[w.first[d] : w.first[d + 1]]
        n, total = len(mine), mine.sum()
        evidence = [1, math.log1p(4 * total), max(mine), math.sqrt(total / n), math.log1p(n) / 10, min(3, int((mine > 0.97).sum()))]
        assert scores[d] == pytest.approx(1 / (1 + math.exp(-sum(x * y for x, y in zip(evidence, field.score)))))


def test_sequences_stay_in_their_texts():
    """Texts that begin with toxic words, and end without, must not be taken for toxic words behind toxic words."""
    texts = [f"nasty plain words number {i}" for i in range(60)] + [f"plain words number {i} only" for i in range(60)]
    field = toxicity.fit(texts, np.array([1] * 60 + [0] * 60), np.ones(120))
    assert field.start > field.moves[0, 1]  # it is learned where texts begin, and that toxic words stand there only


def test_word_vectors_are_sums_over_neighbours(spark):
    texts = ["the cat sat", "the cat ran off", None, "", "Cat 12 the", "sat"] * 3
    docs = table(spark, list(enumerate(texts)))
    where, sign = quality.index_vectors()

    def vector(row):
        v = np.zeros(quality.DIMENSIONS)
        for d, s in zip(where[row], sign[row]):
            v[d] += s
        return v

    sums, n = defaultdict(lambda: np.zeros(quality.DIMENSIONS)), Counter()
    for t in texts:
        words = (t or "").split()
        for kind in ("own", "shape"):
            rows = []
            for x in words:
                part = pa.record_batch([pa.array([1]), pa.array([x])], ["doc_id", "text"])
                _, own, shape = quality.word_rows(part)
                rows.append(int((own if kind == "own" else shape)[0]))
            for i, row in enumerate(rows):
                n[row] += 1
                for j in (i - 1, i + 1):
                    if 0 <= j < len(rows):
                        sums[row] += vector(rows[j])
    got = {r["row"]: r for r in quality.context_sums(docs).collect()}
    assert got.keys() == n.keys()
    for row, r in got.items():
        assert r["n"] == n[row] and [r[f"v{i}"] for i in range(quality.DIMENSIONS)] == pytest.approx(sums[row].tolist())
    vectors = quality.word_vectors(docs)
    row = max(n, key=n.get)
    v = sums[row] + vector(row) * n[row]
    share = n[row] / (sum(n.values()) / 2)
    assert vectors[row].tolist() == pytest.approx((v / np.linalg.norm(v) * 1e-2 / (1e-2 + share)).tolist(), rel=1e-4, abs=1e-7)


def test_filter_hits_are_the_languages_ngrams():
    r = random.Random(5)
    words = {x: ["".join(r.choice(letters) for _ in range(r.randrange(3, 9))) for _ in range(400)] for x, letters in (("aa", "abcdefgh"), ("bb", "ghijklmnop"), ("cc", "opqrstuvwxyz"))}
    grams = {x: np.unique(language_id.ngrams(*K.buffers(pa.array([" ".join(w)])))[0]) for x, w in words.items()}
    filters = language_id.Filters.of(sorted(grams), grams)
    assert filters.slots >= language_id.SLOTS_EACH * max(map(len, grams.values()))
    texts = [" ".join(r.choice(words[x]) for _ in range(50)) for x in words] + ["", "ab 12 cd", " ".join(words["aa"][:20] + words["cc"][:20])]
    h, doc = language_id.ngrams(*K.buffers(pa.array(texts)))
    hits = filters.hits(h, doc, len(texts))
    for d in range(len(texts)):
        mine = h[doc == d].tolist()
        for i, x in enumerate(sorted(grams)):
            there = sum(g in set(grams[x].tolist()) for g in mine)
            assert there - 0.02 * len(mine) - 1 <= hits[d, i] <= there + 0.02 * len(mine) + 1  # corrected for the false ones


def test_tables_without_rows(spark):
    prepare(spark)
    empty = table(spark, [])
    assert byte_bpe.encode_table(empty).count() == 0 and byte_bpe.decode_table(byte_bpe.encode_table(empty)).count() == 0
    filters = language_id.fit_filters(empty)
    assert filters.languages == [] and language_id.identify(empty, filters).count() == 0
    vectors = quality.word_vectors(empty)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_documents(empty, vectors, quality.fit_quality(empty, labels, vectors)).count() == 0


def test_pipeline_of_nothing(spark, tmp_path):
    table(spark, []).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


@pytest.mark.parametrize("rows,want", [
    ([(5, "alpha beta"), (5, "gamma delta"), (6, "alpha beta"), (7, "epsilon")], ["alpha beta", "epsilon", "gamma delta"]),
    ([(5, "epsilon"), (5, "gamma delta"), (3, "epsilon")], ["epsilon", "gamma delta"]),
    ([(None, "a"), (None, "b"), (None, "a"), (1, "b"), (1, None), (1, "")], ["", "a", "b"]),
    ([], []),
])
def test_rows_that_share_an_id_keep_their_texts(spark, rows, want):
    stages = dict(corpus_pipeline.STAGES)
    got = stages["exact_dedup"](spark, table(spark, rows), "")
    assert sorted(r["text"] or "" for r in got.collect()) == want and got.columns == table(spark, []).columns
    near = stages["ngram_jaccard"](spark, table(spark, [(9, "one two three four five six seven"), (9, "quite another text"), (8, "one two three four five six seven")]), "")
    assert sorted((r["doc_id"], r["text"][:3]) for r in near.collect()) == [(8, "one"), (9, "qui")]


def test_leaks_are_told_apart_by_row(spark, tmp_path):
    spark.createDataFrame([(1, "what is the name of the largest lake of the land")], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    rows = [(4, "x what is the name of the largest lake of the land y"), (4, "a clean text"), (5, None)]
    got = dict(corpus_pipeline.STAGES)["decontamination"](spark, table(spark, rows), f"file://{tmp_path}")
    assert sorted((r["doc_id"], r["text"]) for r in got.select("doc_id", "text").collect() if r["text"]) == [(4, "a clean text")] and got.count() == 2


def test_long_and_repeated_texts(spark):
    rows = [(11, LONG), (12, LONG), (12, LONG), (13, LONG + " x"), (14, " ".join(LONG.split()[:40_000])), (15, None)]
    docs = table(spark, rows)
    exact = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs).collect())
    assert exact == [(11, 11, 3, True), (12, 11, 3, False), (12, 11, 3, False), (13, 13, 1, True), (14, 14, 1, True), (15, 15, 1, True)]
    near = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_groups(docs).collect())
    assert [c for _, c in near] == [11, 11, 11, 11, 11, 15]  # the words go round, so the sets are nearly all equal
    cut = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.repeated_windows(docs).collect()}
    assert cut == {11: (60_000, 0), 12: (60_000, 60_000), 13: (60_001, 60_000), 14: (40_000, 40_000), 15: (0, 0)}
    vectors = quality.word_vectors(docs)
    net = quality.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"), vectors)
    scores = [(r["doc_id"], r["score"]) for r in quality.score_documents(docs, vectors, net).collect()]
    assert len(scores) == 6 and len({s for d, s in scores if d in (11, 12)}) == 1
    filters = language_id.Filters.of(["xx"], {"xx": np.arange(10, dtype=np.uint64)})
    assert [r["lang_pred"] for r in language_id.identify(docs.where("doc_id < 15"), filters).collect()] == ["xx"] * 5
