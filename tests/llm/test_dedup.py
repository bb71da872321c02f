"""Exact, near and substring duplicates against brute force on small tables with every odd case."""

import random
import uuid
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from larkspool.llm import kernels as K
from larkspool.llm import exact_dedup as exact_module
from larkspool.llm import partition_index as X
from larkspool.llm.components import components
from larkspool.llm.exact_dedup import DigestIndex, exact_dedup
from larkspool.llm.jaccard_join import Jaccard, jaccard_groups
from larkspool.llm.substring_dedup import repeated_windows
from larkspool.llm.scratch import prepare, shared_dir, written

DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig long, key string, h1 string"


def table(spark, rows):
    """Rows (doc_id, text) with more columns, some of whose names the operators use inside."""
    prepare(spark)
    return spark.createDataFrame([(d, t, None, "s", None, 1, "k", "h") for d, t in rows], DOCS).repartition(3)


def split(text):
    return (text or "").encode().split()


def lower(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def corpus(seed, n=60, words=80):
    """Copies, near copies, shared passages, short and odd texts."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n\x0b\x0c\r"), (3, "one"), (4, "One"), (5, "one two"), (6, "a\x1cb\x85c\xa0d"), (7, "é 😀 é")]
    passage = [r.choice(vocabulary) for _ in range(60)]
    base = [r.choice(vocabulary) for _ in range(words)]
    while len(rows) < n:
        kind, d = r.random(), len(rows)
        if kind < 0.35:
            w = list(base)
            for _ in range(r.randrange(6)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
        elif kind < 0.5:
            w = [r.choice(vocabulary) for _ in range(r.randrange(30))] + passage[r.randrange(8) :] + [r.choice(vocabulary) for _ in range(r.randrange(30))]
        elif kind < 0.7:
            w = split(rows[r.randrange(len(rows))][1]) and [x.decode() for x in split(rows[r.randrange(8, len(rows))][1])] if len(rows) > 8 else base
        else:
            w = [r.choice(vocabulary[:30]) for _ in range(r.randrange(1, 12))]
        rows.append((d, " ".join(w) + r.choice(["", "\n", " "])))
    return rows


def test_exact(spark):
    rows = corpus(1) + [(200, "x y"), (201, "xy "), (202, "x\ty"), (202, "x\ty")]
    groups = {}
    for d, t in rows:
        groups.setdefault(b"".join(split(t)), []).append((-len(t or ""), d))
    got = {(r["doc_id"]): r for r in exact_dedup(table(spark, rows)).collect()}
    for d, t in rows:
        g = groups[b"".join(split(t))]
        keep = min(g)[1]
        r = got[d]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (keep, len(g), keep == d, sha256(b"".join(split(t))).hexdigest())
    assert exact_dedup(table(spark, [])).count() == 0


def test_index_is_kept_and_appended(spark):
    prepare(spark)
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    index = DigestIndex(spark, path, buckets=4)
    first = {r["doc_id"]: r["kept"] for r in index.add(table(spark, [(5, "a b"), (6, "c")])).collect()}
    assert first == {5: True, 6: True}
    index.close()
    with pytest.raises(ValueError):  # files that are no index are never written over
        DigestIndex(spark, path.rsplit("/", 1)[0])
    # another session: another catalogue entry, the same folder and its number of buckets
    index = DigestIndex(spark, path, buckets=7)
    assert index.buckets == 4
    verdicts = index.add(table(spark, [(1, "ab"), (7, "d"), (8, " d"), (9, "c c")]))
    second = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in verdicts.collect()}
    assert second == {1: (5, False), 7: (8, False), 8: (8, True), 9: (9, True)}
    third = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in index.add(table(spark, [(3, "a  b"), (4, "c"), (None, "d"), (None, "zz")])).collect()}
    assert third[3] == (3, True) and third[4] == (4, True)  # longer, and as long with a smaller doc_id
    assert sorted(r["old"]["doc_id"] or 0 for r in index.keepers().collect()) == [0, 3, 4, 8, 9]
    plan = index.keepers()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # bucketed by digest


def test_first_load_is_an_anti_join(spark):
    """The verdicts of a new index come through the anti-join too, and the index is never shuffled."""
    plans = []

    def held(df, name):
        if name == "digest_winners":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    prepare(spark)
    old, exact_module.written = exact_module.written, held
    try:
        exact_dedup(table(spark, [(1, "a"), (2, " a")])).collect()
    finally:
        exact_module.written = old
    assert "SortMergeJoin" in plans[0] and "LeftAnti" in plans[0]
    for part in plans[0].split("SortMergeJoin")[1:]:
        assert "Bucketed: true" in part


def brute_groups(rows, size, percent):
    sets = {}
    for d, t in rows:
        w = lower(t).split()
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    part = {d: d for d in sets}

    def find(x):
        return x if part[x] == x else find(part[x])

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                part[high] = low
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("size,percent,seed", [(3, 90, 2), (5, 80, 3), (1, 60, 4)])
def test_near(spark, size, percent, seed):
    rows = corpus(seed, 120, 150 if seed == 2 else 60)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_groups(table(spark, rows), Jaccard(size, percent)).collect()}
    assert got == brute_groups(rows, size, percent)


def test_near_in_a_hot_group(spark):
    """2,000 variants of one text, most pairs of them just under the similarity: links, and few pairs that come to nothing."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(160)]
    rows = []
    for d in range(2000):
        w = list(base)
        for i in r.sample(range(0, 160, 4), 4):  # each change touches five shingles
            w[i] = f"x{r.randrange(10**6)}" if r.random() < 0.9 else "same"
        rows.append((d, " ".join(w)))
    sets = {}
    shingles = [{sets.setdefault(tuple(w[i : i + 5]), len(sets)) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    there = np.zeros((len(rows), len(sets)), dtype=np.float32)
    for d, s in enumerate(shingles):
        there[d, list(s)] = 1
    both, n = there @ there.T, there.sum(axis=1)
    linked = 100 * both >= 80 * (n[:, None] + n[None, :] - both)
    assert 0 < np.triu(linked, 1).mean() < 0.5
    label = np.arange(len(rows))
    while True:
        least = np.where(linked, label[None, :], len(rows)).min(axis=1)
        if (least == label).all():
            break
        label = least
    got = {r["doc_id"]: r["component_id"] for r in jaccard_groups(table(spark, rows)).collect()}
    assert got == dict(enumerate(label.tolist()))


def test_near_of_nothing(spark):
    assert jaccard_groups(table(spark, [])).count() == 0
    assert [tuple(r) for r in jaccard_groups(table(spark, [(4, None), (3, " ")])).orderBy("doc_id").collect()] == [(3, 0, 3), (4, 0, 4)]


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_always_share_a_key(percent):
    """The index itself, over all sizes with as many differences as the similarity allows, wherever they are."""
    r = np.random.default_rng(percent)
    for n in [*range(1, 150), *range(150, 1200, 37)]:
        for _ in range(6):
            x = np.unique(r.integers(0, 1 << 62, n).astype(np.uint64))
            most = (100 - percent) * 2 * len(x) // (100 + percent)
            drop = int(r.integers(0, most + 1))
            y = np.unique(np.concatenate([r.permutation(x)[drop:], r.integers(0, 1 << 62, most - drop).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if not len(y) or 100 * both < percent * (len(x) + len(y) - both):
                continue
            doc = np.concatenate([np.zeros(len(x), dtype=np.int64), np.ones(len(y), dtype=np.int64)])
            e = X.index_keys(doc, np.concatenate([x, y]), 2, percent)
            before = X.earlier_keys(e, 5)
            rows = [{int(k): i for i, k in zip(np.flatnonzero(e.doc == d), e.key[e.doc == d])} for d in (0, 1)]
            common = rows[0].keys() & rows[1].keys()
            assert common, (n, drop)
            met, given = {}, 0
            for k in common:
                i, j = rows[0][k], rows[1][k]
                assert e.band[i] == e.band[j]
                met.setdefault(e.band[i], []).append(max(e.bound[i], e.bound[j]))
                same = before[i] == before[j]
                assert set(before[i][same].tolist()) <= common  # who is passed over here meets elsewhere
                given += not same.any()
            assert any(len(bounds) >= max(bounds) for bounds in met.values()) and given, (n, drop)


def brute_windows(rows, window):
    first = {}
    for d, t in rows:
        w = split(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(d, first.get(k, d))
    out = {}
    for d, t in rows:
        w = split(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), sum(gone), sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_windows(spark, seed):
    rows = corpus(seed, 90, 120)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeated_windows(table(spark, rows)).collect()}
    ref = brute_windows(rows, 50)
    assert got == ref and any(v[1] for v in ref.values())


def test_windows_of_rows_that_share_an_id_or_have_none(spark):
    long = " ".join(f"t{i}" for i in range(70))
    got = repeated_windows(table(spark, [(5, long), (5, long + " x"), (None, long), (9, long)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in got) == [(0, 70, 0), (5, 70, 0), (5, 71, 0), (9, 70, 70)]
    assert repeated_windows(table(spark, [])).count() == 0


def test_components(spark):
    r = random.Random(0)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(2000, 2100)]
    part = {}

    def find(x):
        while part.setdefault(x, x) != x:
            x = part[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        part[high] = low
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in part if find(x) != x or any(find(y) == x and y != x for y in part)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_kernels():
    texts = ["a bb  ccc", "", None, "\tx", "é ü"]
    data, offsets = K.buffers(pa.array(texts))
    w = K.words(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(w.start, w.end)] == ["a", "bb", "ccc", "x", "é", "ü"]
    assert w.counts().tolist() == [3, 0, 0, 1, 2]
    same = K.words(*K.buffers(pa.array(["zz bb a"]))).hashes()
    assert same[1] == w.hashes()[1] and same[2] == w.hashes()[0] and len(set(w.hashes().tolist())) == 6
    values = np.random.default_rng(0).integers(0, 9, 50)
    for size in (1, 2, 7, 43):
        assert K.sliding_min(values, size).tolist() == [values[i : i + size].min() for i in range(50 - size + 1)]
