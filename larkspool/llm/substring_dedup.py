"""Substring deduplication: Rabin-Karp hashes of token windows, counted in Spark and merged into maximal intervals.

Every window of every text is hashed.  Counting all of them would shuffle a row for each token, so windows that can't
repeat are told apart first: each window has an anchor, the smallest hash of its runs of ``gram`` tokens, and equal
windows have equal anchors, about two for each ``window`` tokens.  A window whose anchor is in one text only is unique;
the others are shuffled and counted by a 96-bit hash.  Whole texts that repeat are settled before that by their digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .scratch import forget, table, written

U64 = np.uint64
WINDOW, GRAM = 50, 8
#: A list of ids up to this many (8 bytes each) is broadcast to pick texts; a longer one is joined by shuffling.
BROADCAST_IDS = 2_000_000


def _anchors(hashes: np.ndarray, w: K.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of every window inside one text, and the index of the window's first word."""
    if len(hashes) < window:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    every = np.arange(len(hashes) - gram + 1)
    grams = K.mix(K.spans_hash(hashes, every, every + gram, K.WORD_BASES[1]))
    at = np.arange(len(hashes) - window + 1)
    at = at[w.doc[: len(at)] == w.doc[window - 1 :]]
    return K.sliding_min(grams, window - gram + 1)[at], at


def _digests(hashes: np.ndarray, w: K.Words) -> tuple[np.ndarray, np.ndarray]:
    n = w.counts().astype(U64)
    return tuple(K.mix(K.spans_hash(hashes, w.first[:-1], w.first[1:], base) + n) if len(hashes) else K.mix(n) for base in K.WORD_BASES)


def _runs(keys: np.ndarray, values: np.ndarray, docs: int) -> pa.Array:
    """values as one list for each doc; keys ascending."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(keys, np.arange(docs + 1)), pa.int32()), K.signed(values))


def sheets(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Of every text: words, two digests of its words, the digest of its words joined by spaces, and its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                w = K.words(*K.buffers(part.column(1)))
                h = w.hashes()
                d1, d2 = _digests(h, w)
                anchor, at = _anchors(h, w, window, gram)
                doc = w.doc[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                said = [sha256(b" ".join((t.as_py() or "").encode().split())).hexdigest() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(w.counts().astype(np.int64)), K.signed(d1), K.signed(d2), pa.array(said), _runs(doc[new], anchor[new], part.num_rows)],
                    ["doc_id", "n_words", "d1", "d2", "whole_sha256", "anchors"],
                )

    return docs.mapInArrow(run, "doc_id long, n_words long, d1 long, d2 long, whole_sha256 string, anchors array<long>")


def window_rows(marked: DataFrame, window: int, gram: int) -> DataFrame:
    """Hash, document and place of the windows of marked(doc_id, text, d1, anchors) whose anchor is among ``anchors``.

    A place is the window's first word, below the high 32 bits of the text's digest (rows may share a doc_id).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                w = K.words(*K.buffers(part.column(1)))
                h = w.hashes()
                d1, _ = _digests(h, w)
                anchor, at = _anchors(h, w, window, gram)
                edge = np.searchsorted(w.doc[at], np.arange(part.num_rows + 1))
                wanted = part.column(2).to_numpy(zero_copy_only=False)
                keep = np.zeros(len(at), dtype=bool)
                for i in np.flatnonzero(wanted == d1.view(np.int64)):
                    known = part.column(3)[int(i)].values.to_numpy(zero_copy_only=False)
                    keep[edge[i] : edge[i + 1]] = np.isin(anchor[edge[i] : edge[i + 1]].view(np.int64), known)
                at = at[keep]
                if not len(at):
                    continue
                doc = w.doc[at]
                one = K.mix(K.spans_hash(h, at, at + window, K.WORD_BASES[0]) + U64(window))
                two = K.spans_hash(w.hashes(1), at, at + window, K.WORD_BASES[1])
                place = (d1[doc] >> U64(32) << U64(32)) | (at - w.first[doc]).astype(U64)
                yield pa.RecordBatch.from_arrays([K.signed(one), pa.array((K.mix(two) >> U64(32)).astype(np.uint32).view(np.int32)), part.column(0).take(pa.array(doc)), K.signed(place)], ["h1", "h2", "doc_id", "place"])

    return marked.select("doc_id", "text", "d1", "anchors").mapInArrow(run, "h1 long, h2 int, doc_id long, place long")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """Removal intervals, their words and the digest of what stays, of texts(doc_id, text, tag, starts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in K.slices(batch, "text")):
            rows = []
            for doc_id, text, tag, starts in zip(*(c.to_pylist() for c in part.columns), strict=True):
                words = (text or "").encode().split()
                one = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
                w = K.words(*K.buffers(one.column(0)))
                if int(_digests(w.hashes(), w)[0][0]) >> 32 != tag & 0xFFFFFFFF:
                    continue  # another row with this doc_id
                kept, spans, done = [], [], 0
                for start in sorted(starts):
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], start + window)
                    else:
                        spans.append([start, start + window])
                for low, high in spans:
                    kept += words[done:low]
                    done = high
                kept += words[done:]
                rows.append((doc_id, tag, len(words) - len(kept), [{"start": a, "end": b} for a, b in spans], sha256(b" ".join(kept)).hexdigest()))
            if rows:
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                kinds = (pa.int64(), pa.int64(), pa.int64(), span, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "tag", "n_cut", "spans", "cut_sha256"])

    return texts.select("doc_id", "text", "tag", "starts").mapInArrow(run, "doc_id long, tag long, n_cut long, spans array<struct<start: long, end: long>>, cut_sha256 string")


def _picked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """docs joined with wanted on doc_id; where the ids are few, other texts are not shuffled."""
    ids = wanted.select("doc_id").distinct()
    if ids.count() <= BROADCAST_IDS:
        docs = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    return docs.join(wanted, "doc_id")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Of every row of docs(doc_id, text): n_words, n_removed, kept_sha256 and the removed intervals of words.

    A word goes if a window of ``window`` words over it also starts in a document with a smaller doc_id, judged on the
    input.  Words are separated by ASCII white space, unchanged.  Null and empty texts and texts shorter than a window
    lose nothing; long ones are read whole.  An empty table gives no rows.  Rows that share a doc_id take nothing from each other; rows without one neither take nor lose.
    Other columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sheet = written(sheets(texts, window, gram), "windows_sheets")
    first = sheet.where("doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("first_id"))
    first = written(first, "windows_first")
    sheet = sheet.join(first, ["d1", "d2"], "left")
    is_first = (F.col("doc_id") == F.col("first_id")) & (F.col("n_words") >= window)
    anchor = sheet.where(is_first).select("doc_id", "d1", F.explode("anchors").alias("anchor"))
    several = written(anchor.groupBy("anchor").agg(F.min("d1").alias("a"), F.max("d1").alias("b")).where("a <> b").select("anchor"), "windows_several")  # common anchors can then be split
    marks = written(anchor.join(several, "anchor").groupBy("doc_id", "d1").agg(F.collect_set("anchor").alias("anchors")), "windows_marks")
    rows = window_rows(_picked(texts, marks), window, gram)
    known = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("h1", "h2", "least")
    known = written(known, "windows_known")  # so that both sides of the join are plain exchanges, whose hot keys can be split
    starts = rows.join(known, ["h1", "h2"]).where("doc_id > least")
    starts = starts.groupBy("doc_id", F.shiftright("place", 32).alias("tag")).agg(F.collect_set(F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))).alias("starts"))
    starts = written(starts, "windows_starts")
    cut = written(_cut(_picked(texts, starts), window).distinct(), "windows_cut")
    forget(several, marks, known, starts)
    sheet = sheet.withColumn("tag", F.shiftright("d1", 32)).drop("anchors")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= window)
    return sheet.join(cut, ["doc_id", "tag"], "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(sha256(b"").hexdigest())).otherwise(F.coalesce("cut_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(copy, F.expr("array(named_struct('start', 0L, 'end', n_words))")).otherwise(F.coalesce("spans", F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)"))).alias("removed"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP7_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
tok AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], chr(0))) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
hit AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) < doc_id AS gone FROM win),
cov AS (SELECT t.doc_id, t.i, t.word, coalesce(bool_or(coalesce(hit.gone, false)) OVER (PARTITION BY t.doc_id ORDER BY t.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM tok t LEFT JOIN hit ON hit.doc_id = t.doc_id AND hit.i = t.i),
agg AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM cov GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM w LEFT JOIN agg ON w.doc_id = agg.doc_id
"""
