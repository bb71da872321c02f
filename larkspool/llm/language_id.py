"""Language by n-gram filters: a Bloom filter whose slots hold a bit for each language.

Every frequent byte n-gram of a language's training texts sets the language's bit in ``HASHES`` slots; the slots of an
n-gram, combined by AND, tell all languages that contain it at once.  A text's hits of each language are counted by its
bit, corrected for the filter's false positives, and the largest corrected share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .labelled import bounded, fold
from .toxicity import lowered
from .scratch import table

U64 = np.uint64
NGRAM = 4
HASHES = 2
#: Slots of the filter for each n-gram of the language with the most of them, at least; a power of two of them in all.
SLOTS_EACH = 16
#: Training documents for each language, at most.
FIT_EACH = 4000
#: An n-gram is a language's if it makes this share of its n-grams at least (so none has over 100,000), and this part of the
#: largest share that it has in any language.
LEAST_SHARE, LEAST_PART = 1e-5, 0.08
UNKNOWN = "und"
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every n-gram of lowered letters; runs of other bytes are one blank, and so is a text's edge."""
    low = np.where(LETTER[data], lowered(data), np.uint8(0x20))
    n = len(low)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = np.ones(n, dtype=bool)
    keep[1:] = (low[1:] != 0x20) | (low[:-1] != 0x20) | (doc[1:] != doc[:-1])
    low, doc = low[keep].astype(U64), doc[keep]
    if len(low) < NGRAM:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    code = low[: len(low) - NGRAM + 1].copy()
    for i in range(1, NGRAM):
        code = code << U64(8) | low[i : len(low) - NGRAM + 1 + i]
    whole = doc[: len(code)] == doc[NGRAM - 1 :]
    return K.mix(code[whole]), doc[: len(code)][whole]


def _slots(h: np.ndarray, slots: int) -> list[np.ndarray]:
    return [((h >> U64(24 * i)) % U64(slots)).astype(np.int64) for i in range(HASHES)]


@dataclass
class Filters:
    """Languages, and for each group of 64 of them the slots' masks; false-positive rates by language."""

    languages: list[str]
    slots: int
    masks: list[np.ndarray]
    false_rate: np.ndarray

    @staticmethod
    def of(languages: list[str], grams: dict[str, np.ndarray]) -> Filters:
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        slots = 1 << max(10, int(SLOTS_EACH * max((len(g) for g in grams.values()), default=1) - 1).bit_length())
        masks = [np.zeros(slots, dtype=kind) for _ in range(-(-len(languages) // 64))]
        rates = []
        for i, language in enumerate(languages):
            bit = kind(1 << (i % 64))
            for at in _slots(grams[language], slots):
                masks[i // 64][at] |= bit
            rates.append(float(((masks[i // 64] & bit) != 0).mean()) ** HASHES)
        return Filters(languages, slots, masks, np.array(rates))

    def hits(self, h: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        """For each text and language, the n-grams that its filter holds, less the expected false ones."""
        at = _slots(h, self.slots)
        n = np.bincount(doc, minlength=docs)
        out = np.zeros((docs, len(self.languages)))
        for g, mask in enumerate(self.masks):
            found = mask[at[0]]
            for more in at[1:]:
                found &= mask[more]
            for i in range(64 * g, min(64 * g + 64, len(self.languages))):
                held = (found & mask.dtype.type(1 << (i % 64))) != 0
                out[:, i] = np.bincount(doc[held], minlength=docs)
        return np.maximum(0.0, (out - n[:, None] * self.false_rate) / (1 - self.false_rate))


def fit_filters(docs: DataFrame) -> Filters:
    """Filters from a bounded sample of each language's documents (not held out, with a text and a lang)."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null").where(fold(4) != 2)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                h, doc = ngrams(*K.buffers(part.column(1)))
                names, which = np.unique(np.array(part.column(2).to_pylist(), dtype=object).astype(str), return_inverse=True)
                for i, name in enumerate(names):
                    got, n = np.unique(h[which[doc] == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([str(name)] * len(got), pa.string()), K.signed(got), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counts = bounded(known, "lang", FIT_EACH).mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total")).where(F.col("share") >= LEAST_SHARE)
    most = share.groupBy("gram").agg(F.max("share").alias("most"))
    # a share of 1e-5 at least bounds what reaches the driver to 100,000 n-grams for each language
    rows = share.join(most, "gram").where(F.col("share") >= LEAST_PART * F.col("most")).select("lang", "gram", "share").toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("share", "descending"), ("gram", "ascending")])
    languages = sorted(set(rows.column("lang").to_pylist()))
    lang, gram = np.array(rows.column("lang").to_pylist(), dtype=object), rows.column("gram").to_numpy().view(U64)
    return Filters.of(languages, {x: gram[lang == x] for x in languages})


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """lang_pred and score of every row of docs(doc_id, text).

    A null text and a text without a letter are ``und`` with score 0; so is everything if nothing was learned.  A text
    with letters but no known n-gram gets the first language and score 0; of tied languages the first is taken.  Long texts are
    read whole.  An empty table gives no rows, and every row one, repeated ones too.  Other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part in K.slices(batch, "text"):
                data, offsets = K.buffers(part.column(1))
                docs_here = part.num_rows
                ascii_letter = np.concatenate([[0], np.cumsum(LETTER[data] & (data < 0x80))])
                other = np.concatenate([[0], np.cumsum(data >= 0x80)])
                lettered = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
                for i in np.flatnonzero(~lettered & (other[offsets[1:]] > other[offsets[:-1]])):
                    lettered[i] = any(map(str.isalpha, part.column(1)[int(i)].as_py()))
                if not model.languages:
                    lettered[:] = False
                    hits = np.zeros((docs_here, 1))
                else:
                    hits = model.hits(*ngrams(data, offsets), docs_here)
                best = np.where(lettered, hits.argmax(axis=1), len(model.languages))
                total = hits.sum(axis=1)
                score = np.where(lettered & (total > 0), hits.max(axis=1) / np.where(total > 0, total, 1), 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_filters(docs)).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")
