"""Document quality by random-indexing word vectors, a two-layer network and a calibrated temperature.

Words are hashed into fixed rows twice: as themselves and as their shape (runs of letters, capitals and digits shortened).
A row's vector is the sum of the sparse random index vectors of its neighbours over the whole corpus, added up by Spark.
A document is the mean of its words' vectors; a numpy network is fitted on a bounded sample of labelled documents.
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
#: Rows for words and for shapes, dimensions, and nonzero entries of an index vector.
ROWS, SHAPES, DIMENSIONS, NONZERO = 1 << 18, 1 << 10, 24, 3
HIDDEN = 24
#: Labelled documents of each label that the network is fitted on, at most; a fifth of them sets the temperature.
FIT_EACH = 4000
THRESHOLD = 0.3
_SHAPE = np.full(256, ord("?"), dtype=np.uint8)
_SHAPE[0x21:0x7F] = np.arange(0x21, 0x7F)
_SHAPE[0x30:0x3A] = ord("0")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[[0x20, *range(0x09, 0x0E)]] = 0x20


def word_rows(part: pa.RecordBatch) -> tuple[K.Words, np.ndarray, np.ndarray]:
    """Words of a slice with their rows and the rows of their shapes."""
    data, offsets = K.buffers(part.column(1))
    w = K.words(data, offsets)
    own = (w.hashes() % U64(ROWS)).astype(np.int64)
    shape = _SHAPE[data]
    keep = np.ones(len(shape), dtype=bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[offsets[:-1][offsets[:-1] < len(shape)]] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    short = K.words(shape[keep], at[offsets])
    return w, own, (short.hashes() % U64(SHAPES)).astype(np.int64) + ROWS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and signs of the nonzero entries of every row's index vector."""
    h = K.mix(np.arange((ROWS + SHAPES) * NONZERO, dtype=U64) ^ U64(0xA24BAED4963EE407)).reshape(-1, NONZERO)
    return (h % U64(DIMENSIONS)).astype(np.int64), np.where((h >> U64(40)) & U64(1), np.float32(1), np.float32(-1))


def context_sums(docs: DataFrame) -> DataFrame:
    """row, n (its words) and the sums v0.. of its neighbours' index vectors over all texts."""
    names = ["row", "n", *(f"v{i}" for i in range(DIMENSIONS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, sign = index_vectors()
        total, seen = np.zeros((ROWS + SHAPES) * DIMENSIONS, dtype=np.float32), np.zeros(ROWS + SHAPES)
        for batch in batches:
            for part in K.slices(batch, "text"):
                w, own, shape = word_rows(part)
                inside = w.doc[1:] == w.doc[:-1]
                for rows in (own, shape):
                    np.add.at(seen, rows, 1.0)
                    a, b = rows[:-1][inside], rows[1:][inside]
                    for x, y in ((a, b), (b, a)):
                        for k in range(NONZERO):
                            np.add.at(total, x * DIMENSIONS + where[y, k], sign[y, k])
        some = np.flatnonzero(seen)
        vectors = total.reshape(-1, DIMENSIONS)[some]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some]), *(pa.array(vectors[:, i].copy()) for i in range(DIMENSIONS))], names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = texts.mapInArrow(run, "row long, n double, " + ", ".join(f"{x} float" for x in names[2:]))
    return parts.groupBy("row").agg(F.sum("n").alias("n"), *(F.sum(x).cast("float").alias(x) for x in names[2:]))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all rows, weighted down where a row is frequent; the size is fixed whatever the corpus (25 MB)."""
    rows = context_sums(docs).toArrow()
    vectors, n = np.zeros((ROWS + SHAPES, DIMENSIONS), dtype=np.float32), np.zeros(ROWS + SHAPES)
    at = rows.column("row").to_numpy()
    n[at] = rows.column("n").to_numpy()
    for i in range(DIMENSIONS):
        vectors[at, i] = rows.column(f"v{i}").to_numpy()
    where, sign = index_vectors()
    for k in range(NONZERO):  # a row also stands for itself
        vectors[np.arange(len(vectors)), where[:, k]] += sign[:, k] * np.maximum(n, 1).astype(np.float32)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), np.float32(1e-9))
    share = n / max(1.0, n.sum() / 2)
    vectors *= (1e-2 / (1e-2 + share))[:, None].astype(np.float32)
    return vectors


def pooled(part: pa.RecordBatch, vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of the words and of their shapes, how alike neighbours are, and the length."""
    w, own, shape = word_rows(part)
    docs, n = part.num_rows, w.counts()
    out = np.zeros((docs, 2 * DIMENSIONS + 4), dtype=np.float32)
    filled = n > 0
    for i, rows in enumerate((own, shape)):
        if len(rows):
            sums = np.add.reduceat(vectors[rows], w.first[:-1][filled], axis=0)
            out[filled, i * DIMENSIONS : (i + 1) * DIMENSIONS] = sums / n[filled, None]
            out[:, 2 * DIMENSIONS + i] = np.linalg.norm(out[:, i * DIMENSIONS : (i + 1) * DIMENSIONS], axis=1)
    if len(own) > 1:
        same = (own[1:] == own[:-1]) & (w.doc[1:] == w.doc[:-1])
        out[:, -2] = np.bincount(w.doc[1:][same], minlength=docs) / np.maximum(n, 1)
    out[:, -1] = np.log1p(n) / 10
    return out


@dataclass
class Network:
    """Two layers over standardised inputs; the temperature divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.concatenate([(x - self.mean) / self.scale, np.ones((len(x), 1))], axis=1)
        hidden = np.concatenate([np.tanh(x @ self.first), np.ones((len(x), 1))], axis=1)
        return hidden @ self.second

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, label: np.ndarray, weight: np.ndarray, calibration: np.ndarray, steps: int = 600) -> Network:
    """Adam over all rows but those of ``calibration``, which choose the temperature by their likelihood."""
    rng = np.random.default_rng(7)
    net = Network(np.zeros(x.shape[1]), np.ones(x.shape[1]), rng.normal(0, 0.3, (x.shape[1] + 1, HIDDEN)), np.zeros(HIDDEN + 1))
    fit = ~calibration
    if not fit.any():
        return net
    net.mean, net.scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
    z = np.concatenate([(x[fit] - net.mean) / net.scale, np.ones((fit.sum(), 1))], axis=1)
    y, u = label[fit], weight[fit] / weight[fit].sum()
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (net.first, net.second)]
    for t in range(1, steps + 1):
        hidden = np.tanh(z @ net.first)
        wide = np.concatenate([hidden, np.ones((len(hidden), 1))], axis=1)
        off = (1 / (1 + np.exp(-np.clip(wide @ net.second, -30, 30))) - y) * u
        back = np.outer(off, net.second[:-1]) * (1 - hidden**2)
        for p, g, (m, v) in zip((net.first, net.second), (z.T @ back + 1e-5 * net.first, wide.T @ off + 1e-5 * net.second), moments, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    if calibration.any():
        logit, y, u = net.logits(x[calibration]), label[calibration], weight[calibration]

        def loss(temperature):
            s = np.clip(logit / temperature, -30, 30)
            return (u * (np.logaddexp(0, s) - y * s)).sum()

        net.temperature = float(min(np.geomspace(0.5, 8, 41), key=loss))
    return net


def fit_quality(docs: DataFrame, labels: DataFrame, vectors: np.ndarray) -> Network:
    """Fit on a bounded sample of the labelled rows that are not held out (``FIT_EACH`` for each label)."""
    known = labels_of(labels, "quality").where(fold(5) != 0)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    some = bounded(known, "label", FIT_EACH)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)
    width = 2 * DIMENSIONS + 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                x = pooled(part, sent.value).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(some), "doc_id").select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return fit_network(np.zeros((0, width)), np.zeros(0), np.zeros(0), np.zeros(0, dtype=bool))
    x = rows.column("x").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, width)
    label = (rows.column("label").to_numpy() == 1).astype(float)
    taken = np.bincount(label.astype(int), minlength=2)
    total = np.array([sum(n for v, n in counts.items() if v != 1), counts.get(1, 0)])
    weight = (total / np.maximum(taken, 1))[label.astype(int)]
    calibration = K.mix(rows.column("doc_id").to_numpy().view(U64)) % U64(5) == 0
    return fit_network(x, label, weight, calibration)


def score_documents(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """score (0 to 1) and predicted (score >= 0.3) of every row of docs(doc_id, text).

    Null and empty texts get the score of no words; long ones are read whole.  An empty table gives no rows, and every row
    one, repeated ones too.  Other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, net = sent.value
        for batch in batches:
            for part in K.slices(batch, "text"):
                score = net.scores(pooled(part, known))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    vectors = word_vectors(docs)
    return score_documents(docs, vectors, fit_quality(docs, labels, vectors)).select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")
