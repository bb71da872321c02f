"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals.

Labels are of documents; the field's token labels come from them: a word of a toxic document is toxic if one of its
features (itself, its first or last letters) is found in toxic documents far more often than in others.  The field has two
states and hashed features; forward-backward runs over whole texts as a blocked scan of 2 x 2 products, so a long text
costs no more for each word than a short one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .labelled import bounded, fold, labels_of
from .scratch import table

U64 = np.uint64
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
PREFIXES, SUFFIXES = (3, 4, 5, 6, 7, 8), (4, 6)
#: Hashed features; the last one is the bias.
FEATURES = 1 << 18
#: Labelled documents that the field and the document score are fitted on, at most, for each label; bytes of their texts
#: for each label, and of one such text.
FIT_TOXIC, FIT_CLEAN = 1500, 2500
FIT_BYTES, FIT_TEXT = 6_000_000, 200_000
#: Words of a training sequence, and sequences at most.
SEQUENCE, SEQUENCES = 24, 24_000
#: A word of a toxic document counts if its sign is this part of the document's surest one at least.
EXPLAINED = 0.25
BLOCK = 64
#: Log-likelihood ratio above which a feature counts as a sign of toxic documents (some 100,000 are tried).
SURPRISE = 11.0
THRESHOLD = 0.3


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals of the Latin-1 letters in UTF-8 lowered."""
    out = K.LOWER[data]
    if len(out) > 1:
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[second] += 0x20
    return out


def features(w: K.Words) -> np.ndarray:
    """Feature numbers of each word, one column for each kind; kinds that a word is too short for give the bias."""
    if not len(w.start):
        return np.zeros((0, 1 + len(PREFIXES) + len(SUFFIXES)), dtype=np.int32)
    data = w.data.astype(U64) + U64(1)
    total = np.zeros(len(data) + 1, dtype=U64)
    base = K.BYTE_BASES[0]
    np.cumsum(data * K.powers(base, len(data)), out=total[1:])
    inverse = K.powers(pow(base, -1, 1 << 64), len(data) + 1)

    def of(start, end, kind):
        return (K.mix((total[end] - total[start]) * inverse[start] + U64(kind)) % U64(FEATURES - 1)).astype(np.int32)

    size = w.end - w.start
    columns = [of(w.start, w.end, 1)]
    for n in PREFIXES:
        columns.append(np.where(size > n, of(w.start, np.minimum(w.end, w.start + n), 10 + n), np.int32(FEATURES - 1)))
    for n in SUFFIXES:
        columns.append(np.where(size > n, of(np.maximum(w.start, w.end - n), w.end, 40 + n), np.int32(FEATURES - 1)))
    return np.stack(columns, axis=1)


@dataclass
class Field:
    """Weights of state 1 against state 0, transitions, and the document score's logistic weights."""

    weights: np.ndarray
    start: float
    moves: np.ndarray
    score: np.ndarray

    def marginals(self, emission: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Probability of state 1 at each word; ``begins`` marks the first word of each text."""
        n = len(emission)
        if not n:
            return np.zeros(0)
        blocks = -(-n // BLOCK)
        step = np.empty((blocks * BLOCK, 2, 2))
        step[:] = np.exp(self.moves)
        step[:n][begins] = np.exp([[0.0, self.start], [0.0, self.start]])
        step[n:] = 1.0  # what fills the last block says nothing about the words before it
        e = np.exp(np.clip(emission, -30, 30))
        step[:n, :, 1] *= e[:, None]
        step = step.reshape(blocks, BLOCK, 2, 2)
        product = np.tile(np.eye(2), (blocks, 1, 1))
        for t in range(BLOCK):
            product = np.einsum("bij,bjk->bik", product, step[:, t])
            product /= product.sum(axis=(1, 2), keepdims=True)
        ahead, behind = np.empty((blocks, 2)), np.empty((blocks, 2))
        now = np.array([0.5, 0.5])
        for b in range(blocks):
            ahead[b] = now
            now = now @ product[b]
            now = now / now.sum()
        now = np.array([0.5, 0.5])
        for b in range(blocks - 1, -1, -1):
            behind[b] = now
            now = product[b] @ now
            now = now / now.sum()
        alpha = np.empty((blocks, BLOCK, 2))
        for t in range(BLOCK):
            ahead = np.einsum("bi,bij->bj", ahead, step[:, t])
            ahead /= ahead.sum(axis=1, keepdims=True)
            alpha[:, t] = ahead
        for t in range(BLOCK - 1, -1, -1):
            alpha[:, t] *= behind
            behind = np.einsum("bij,bj->bi", step[:, t], behind)
            behind /= behind.sum(axis=1, keepdims=True)
        alpha = alpha.reshape(-1, 2)[:n]
        return alpha[:, 1] / alpha.sum(axis=1)

    def tag(self, w: K.Words, feature: np.ndarray | None = None) -> np.ndarray:
        begins = np.zeros(len(w.doc), dtype=bool)
        begins[w.first[:-1][w.counts() > 0]] = True
        emission = np.zeros(len(w.doc))
        for column in (features(w) if feature is None else feature).T:
            emission += self.weights[column]
        return self.marginals(emission, begins)

    def evidence(self, w: K.Words, p: np.ndarray) -> np.ndarray:
        """What the document score is made of: expected toxic words, the surest one, their share, the length."""
        docs = len(w.first) - 1
        total = np.bincount(w.doc, weights=p, minlength=docs)
        most = np.zeros(docs)
        np.maximum.at(most, w.doc, p)
        sure = np.bincount(w.doc[p > 0.97], minlength=docs)
        n = w.counts()
        return np.stack([np.ones(docs), np.log1p(4 * total), most, np.sqrt(total / np.maximum(n, 1)), np.log1p(n) / 10, np.minimum(sure, 3)], axis=1)

    def scores(self, w: K.Words, p: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(w, p) @ self.score, -30, 30)))


def _adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x


def fit_score(evidence: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    def gradient(x):
        p = 1 / (1 + np.exp(-np.clip(evidence @ x, -30, 30)))
        return evidence.T @ ((p - label) * weight) / weight.sum() + 1e-4 * x

    return _adam(gradient, np.zeros(evidence.shape[1]), 800, 0.05)


def token_labels(feature: np.ndarray, doc: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Toxic words among those of labelled documents: a feature of theirs tells toxic documents from others."""
    docs = len(label)
    toxic, clean = np.zeros(FEATURES), np.zeros(FEATURES)
    for column in feature.T:  # the kinds of features don't share numbers but for the bias
        seen = np.unique(doc * FEATURES + column)
        of, which = seen // FEATURES, seen % FEATURES
        toxic += np.bincount(which, weights=label[of] == 1, minlength=FEATURES)
        clean += np.bincount(which, weights=label[of] == 0, minlength=FEATURES)
    a, b = max(1, int((label == 1).sum())), max(1, docs - int((label == 1).sum()))
    ratio = np.log((toxic + 0.05) / a) - np.log((clean + 0.5) / b)
    base = min(max(a / docs, 1e-6), 1 - 1e-6)
    q = np.clip(toxic / np.maximum(toxic + clean, 1), 1e-9, 1 - 1e-9)
    surprise = toxic * np.log(q / base) + clean * np.log((1 - q) / (1 - base))  # of the counts, were the feature no sign
    strong = (ratio > 2.5) & (surprise > SURPRISE)
    strong[FEATURES - 1] = False
    sign, signs = np.zeros(len(doc)), np.where(strong, surprise, 0.0)
    for column in feature.T:
        np.maximum(sign, signs[column], out=sign)
    surest = np.zeros(docs)
    np.maximum.at(surest, doc, sign)
    # what stands beside a far surer sign in the same text is most likely explained by it
    return (sign > 0) & (sign >= EXPLAINED * surest[doc]) & (label[doc] == 1)


def fit(texts: list[str], label: np.ndarray, weight: np.ndarray) -> Field:
    """Field and score from labelled texts; ``weight`` undoes the sampling of the classes."""
    one = np.array(sorted({t: i for i, t in reversed(list(enumerate(texts)))}.values()), dtype=int)
    texts, label, weight = [texts[i] for i in one], label[one], weight[one]  # copies are no further evidence
    # slice by slice: the arrays behind the features take some fifty bytes for each byte of text
    rows = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    parts = []
    for part in K.slices(rows, "text"):
        data, offsets = K.buffers(part.column(0))
        w = K.words(lowered(data), offsets, IN_WORD)
        parts.append((features(w), w.counts()))
    counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, dtype=np.int64)
    feature = np.concatenate([f for f, _ in parts]) if parts else np.zeros((0, 1), dtype=np.int32)
    at_part = np.cumsum([0, *(len(f) for f, _ in parts)])
    parts = [n for _, n in parts]
    y = token_labels(feature, np.repeat(np.arange(len(counts)), counts), label) if len(feature) else np.zeros(0, dtype=bool)
    # sequences of one text each: those with toxic words first, then others, both evenly over the texts
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    each = -(-counts // SEQUENCE)
    of = np.repeat(np.arange(len(counts)), each)
    at = first[of] + SEQUENCE * (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each))
    size = np.minimum(first[of + 1] - at, SEQUENCE)
    hot = np.add.reduceat(y, at) > 0 if len(at) else np.zeros(0, dtype=bool)
    some = lambda x, most: x[np.arange(min(len(x), most)) * len(x) // max(1, min(len(x), most))]
    chosen = np.concatenate([some(np.flatnonzero(hot), SEQUENCES // 2), some(np.flatnonzero(~hot), SEQUENCES // 2)])
    begins, size, chosen = at[chosen] == first[of[chosen]], size[chosen], at[chosen]
    weights, moves = np.zeros(FEATURES), np.zeros(4)
    if len(chosen) and y.any():
        place = np.arange(SEQUENCE)
        there = place < size[:, None]  # a short sequence's other places say nothing
        where = np.where(there, chosen[:, None] + place, chosen[:, None])
        f, t = feature[where], y[where].astype(np.int64)
        moved = there[:, 1:]
        used = np.unique(f)
        f = np.searchsorted(used, f).astype(np.int32)
        count = float(size.sum())

        def gradient(x):
            u, start, move = x[:-4], x[-4], np.array([[0.0, x[-3]], [x[-2], x[-1]]])
            e = sum(u[f[:, :, k]] for k in range(f.shape[2]))
            step = np.exp(move)
            alpha = np.empty((len(f), SEQUENCE, 2))
            alpha[:, 0] = np.stack([np.ones(len(f)), np.exp(np.clip(start * begins + e[:, 0], -30, 30))], axis=1)
            alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
            emit = np.stack([np.ones_like(e), np.exp(np.clip(e, -30, 30))], axis=2)
            for i in range(1, SEQUENCE):
                ahead = (alpha[:, i - 1] @ step) * emit[:, i]
                alpha[:, i] = np.where(there[:, i, None], ahead / ahead.sum(axis=1, keepdims=True), alpha[:, i - 1])
            beta = np.ones((len(f), SEQUENCE, 2))
            pairs = np.zeros((2, 2))
            for i in range(SEQUENCE - 1, 0, -1):
                ahead = emit[:, i] * beta[:, i]
                joint = alpha[:, i - 1][:, :, None] * step * ahead[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True))[there[:, i]].sum(axis=0)
                back = ahead @ step.T
                beta[:, i - 1] = np.where(there[:, i, None], back / back.sum(axis=1, keepdims=True), beta[:, i])
            p = alpha * beta
            p = p[:, :, 1] / p.sum(axis=2)
            off = np.where(there, p - t, 0.0)
            g = np.empty_like(x)
            g[:-4] = sum(np.bincount(f[:, :, k].ravel(), weights=off.ravel(), minlength=len(used)) for k in range(f.shape[2]))
            g[-4] = off[begins, 0].sum()
            for k, (i, j) in enumerate(((0, 1), (1, 0), (1, 1))):
                g[-3 + k] = pairs[i, j] - ((t[:, :-1] == i) & (t[:, 1:] == j) & moved).sum()
            return g / count + 1e-6 * x

        x = _adam(gradient, np.concatenate([np.zeros(len(used)), [-2.0, -2.0, 0.0, 0.0]]), 80, 0.15)
        weights[used], moves = x[:-4], x[-4:]
    field = Field(weights, float(moves[0]), np.array([[0.0, moves[1]], [moves[2], moves[3]]]), np.zeros(6))
    if len(label):
        evidence = []
        for n, low, high in zip(parts, at_part[:-1], at_part[1:], strict=True):
            first = np.concatenate([[0], np.cumsum(n)])
            w = K.Words(None, None, None, np.repeat(np.arange(len(n)), n), first)
            evidence.append(field.evidence(w, field.tag(w, feature[low:high])))
        field.score = fit_score(np.concatenate(evidence), label.astype(float), weight)
    else:
        field.score[0] = -3.0
    return field


def fit_field(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit on a bounded sample of the labelled rows that are not held out.

    The sample has ``FIT_TOXIC`` and ``FIT_CLEAN`` documents and ``FIT_BYTES`` bytes of each label, about and at most; texts
    of over ``FIT_TEXT`` bytes are not in it.
    """
    known = labels_of(labels, "toxic").where(fold(4) != 2).select("doc_id", "label")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    toxic, clean = known.where("label = 1"), known.where("label <> 1")
    some = bounded(toxic, "label", FIT_TOXIC).unionByName(bounded(clean, "label", FIT_CLEAN))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")
    rows = rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= FIT_TEXT)
    size = {r["toxic"]: r["bytes"] for r in rows.groupBy((F.col("label") == 1).alias("toxic")).agg(F.sum(F.octet_length("text")).alias("bytes")).collect()}
    share = F.when(F.col("label") == 1, F.lit(min(1.0, FIT_BYTES / max(1, size.get(True) or 0)))).otherwise(F.lit(min(1.0, FIT_BYTES / max(1, size.get(False) or 0))))
    rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_003)) < share * 1_000_003).toArrow()
    rows = rows.sort_by("doc_id")
    label = (rows.column("label").to_numpy() == 1).astype(np.int64)
    texts = rows.column("text").to_pylist()
    taken = np.bincount(label, minlength=2)
    share = np.array([sum(n for v, n in counts.items() if v != 1), counts.get(1, 0)]) / np.maximum(taken, 1)
    return fit([t or "" for t in texts], label, share[label].astype(float))


def score_documents(docs: DataFrame, field: Field, spans: bool = True) -> DataFrame:
    """score (0 to 1), predicted (score >= 0.3) and toxic spans (code point offsets, end not included) of every text.

    Null and empty texts have a score too, that of no words; long ones are read whole.  An empty table gives no rows, and
    every row one, repeated ones too.  Other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in K.slices(batch, "text"):
                data, offsets = K.buffers(part.column(1))
                w = K.words(lowered(data), offsets, IN_WORD)
                p = model.tag(w)
                score = model.scores(w, p)
                columns = [part.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))]
                names = ["doc_id", "score", "predicted"]
                if spans:
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    toxic = np.flatnonzero(p > 0.5)
                    begin = points[offsets[w.doc[toxic]]]
                    pairs = pa.StructArray.from_arrays([pa.array(points[w.start[toxic]] - begin), pa.array(points[w.end[toxic]] - begin)], ["start", "end"])
                    edge = np.searchsorted(w.doc[toxic], np.arange(part.num_rows + 1))
                    columns.append(pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pairs))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, score double, predicted int" + ", spans array<struct<start: long, end: long>>" * spans
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, with all their columns, in one pass."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in K.slices(batch, "text"):
                data, offsets = K.buffers(part.column(at))
                w = K.words(lowered(data), offsets, IN_WORD)
                yield part.filter(pa.array(model.scores(w, model.tag(w)) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op2_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return score_documents(docs, fit_field(docs, labels)).select("doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted", "spans")
