"""Benchmark decontamination by template canonicalisation.

Words are put into a canonical form in which numbers, names and units are typed placeholders, and windows of canonical
words are hashed.  Windows of documents that are also a benchmark item's are joined by hash, so a question is found when
its figures, names or units were exchanged.  Such windows count only if the exchange is consistent: one value in the
item always stands for one value in the document, over all windows of one copy (document and item places apart by the same
number of words).  Values that differ in the item may be equal in the document.

A number or a name may be of several words ("1,250", "New York"): a run of them is one placeholder, so that an exchange may
change how many words there are.  A capital that only begins a sentence makes no name.

Windows of the words themselves are hashed and joined too, so that verbatim passages are found whatever their words are:
short ones, and those rich in figures and names, which have no template.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .scratch import table, written
from .toxicity import IN_WORD, lowered

U64 = np.uint64
#: Words of a window; a shorter item is one window as a whole, and under ``LEAST_ITEM`` words has no template.
WINDOW, LEAST_ITEM = 8, 5
#: Share of a window's words that must be plain words, and windows of an item that must be found (or all it has).
PLAIN_SHARE, LEAST_WINDOWS = 0.5, 3
#: Window hashes of the benchmark up to this many (8 bytes each) go to every task, which drops other windows before the
#: join; with more of them all windows are joined.  Rows of its windows up to this many (100 bytes each) are broadcast; more
#: of them, as when a window is in very many items, are joined by shuffling.
SENT_HASHES, SENT_ROWS = 2_000_000, 300_000
#: Units of measure, fixed values.
UNITS = (
    "mm cm m km in ft yd mi mile miles inch inches foot feet meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg t lb lbs oz ounce ounces pound pounds gram grams kilogram kilograms ton tons tonne tonnes "
    "ml l liter liters litre litres gallon gallons cup cups ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros usd eur percent degree degrees kwh kw watt watts volt volts mph kmh"
).split()
NUMBER, NAME, UNIT = U64(1), U64(2), U64(3)
#: Keeps hashes of words themselves apart from those of templates.
VERBATIM = U64(0x9AE16A3B2F90404F)
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_SENTENCE = np.zeros(256, dtype=bool)
_SENTENCE[[ord(c) for c in ".!?:;\n\r|"]] = True


def _unit_hashes() -> np.ndarray:
    data, offsets = K.buffers(pa.array(UNITS, pa.large_string()))
    return np.unique(K.words(data, offsets, IN_WORD).hashes())


#: What may stand between two words of one number, and between two of one name.
_IN_NUMBER, _IN_NAME = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_IN_NUMBER[[ord(c) for c in ",.:/"]] = True
_IN_NAME[[ord(c) for c in " -"]] = True


@dataclass
class Template:
    """The words of a slice with runs of one number or name as one: value and canonical hashes, kinds, text of each."""

    value: np.ndarray
    form: np.ndarray
    kind: np.ndarray
    doc: np.ndarray
    first: np.ndarray


def canonical(data: np.ndarray, offsets: np.ndarray) -> tuple[K.Words, np.ndarray, Template]:
    """Words, their own hashes (lowered), and the text in canonical form (kind 0 for plain words)."""
    low = lowered(data)
    w = K.words(low, offsets, IN_WORD)
    own = w.hashes()
    kind = np.zeros(len(own), dtype=U64)
    if len(own):
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        kind[digits[w.end] - digits[w.start] == w.end - w.start] = NUMBER
        kind[(kind == 0) & np.isin(own, _unit_hashes())] = UNIT
        # a capital inside a sentence makes a name: nothing that ends a sentence stands between it and the word before
        ends = np.concatenate([[0], np.cumsum(_SENTENCE[data])])
        inside = np.zeros(len(own), dtype=bool)
        inside[1:] = (w.doc[1:] == w.doc[:-1]) & (ends[w.start[1:]] == ends[w.end[:-1]])
        lead = low[w.start] != data[w.start]
        second = np.minimum(w.start + 1, len(data) - 1)
        lead |= (data[w.start] == 0xC3) & (low[second] != data[second])
        capitals = np.concatenate([[0], np.cumsum(low != data)])  # words in capitals throughout are shouted, not names
        single = (capitals[w.end] - capitals[w.start] == 1) & (w.end - w.start > 1)
        kind[(kind == 0) & inside & lead & single] = NAME
    # words that go on with the number or the name before them
    on = np.zeros(len(own), dtype=bool)
    if len(own) > 1:
        gap = data[np.minimum(w.end[:-1], len(data) - 1)]
        near = (kind[1:] == kind[:-1]) & (w.doc[1:] == w.doc[:-1]) & (w.start[1:] - w.end[:-1] == 1)
        on[1:] = near & (((kind[1:] == NUMBER) & _IN_NUMBER[gap]) | ((kind[1:] == NAME) & _IN_NAME[gap]))
    head = np.flatnonzero(~on)
    end = np.append(head[1:], len(own))
    value = np.where(end - head == 1, own[head], K.mix(K.spans_hash(own, head, end, K.WORD_BASES[1]) + (end - head).astype(U64))) if len(own) else own
    kind, doc = kind[head], w.doc[head]
    form = np.where(kind == 0, value, K.mix(kind ^ U64(0x6C62272E07BB0142)))
    return w, own, Template(value, form, kind, doc, np.searchsorted(doc, np.arange(len(offsets))))


def template_windows(t: Template, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of the windows with enough plain words."""
    h, at = K.windows(t.form, t, size)
    plain = np.concatenate([[0], np.cumsum(t.kind == 0)])
    keep = plain[at + size] - plain[at] >= PLAIN_SHARE * size
    return h[keep], at[keep]


def window_rows(texts: DataFrame, key: str, sizes: tuple[int, ...], whole: bool, known: np.ndarray | None) -> DataFrame:
    """(hash, key, place, size, exact, slots) of the windows; ``whole``: texts of fewer words than the longest window as one.

    Each window gives a row of its words (exact, without slots) and, with enough plain words, one of its template; slots
    are the hashes of the values behind the placeholders, in order.  ``known`` (sorted) keeps other hashes out.
    """
    sent = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                w, own, t = canonical(*K.buffers(part.column(1)))
                slot = np.flatnonzero(t.kind)
                for size in sizes:
                    h, at = K.windows(own, w, size)
                    kinds = [(True, w, K.mix(h ^ VERBATIM), at)]
                    if size >= LEAST_ITEM:
                        kinds.append((False, t, *template_windows(t, size)))
                    for exact, of, h, at in kinds:
                        if whole:  # only texts of just this many words, and those the longest windows fit in
                            mine = (np.diff(of.first)[of.doc[at]] == size) if size < WINDOW else np.ones(len(at), dtype=bool)
                            h, at = h[mine], at[mine]
                        if sent.value is not None and len(h):
                            hit = np.minimum(np.searchsorted(sent.value, h), len(sent.value) - 1)
                            hit = sent.value[hit] == h if len(sent.value) else np.zeros(len(h), dtype=bool)
                            h, at = h[hit], at[hit]
                        if not len(h):
                            continue
                        low, high = np.searchsorted(slot, at), np.searchsorted(slot, at + (0 if exact else size))
                        offsets = np.concatenate([[0], np.cumsum(high - low)])
                        which = np.repeat(low - offsets[:-1], high - low) + np.arange(offsets[-1])
                        values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), K.signed(t.value[slot[which]]))
                        where = pa.array((at - of.first[of.doc[at]]).astype(np.int64))
                        columns = [K.signed(h), part.column(0).take(pa.array(of.doc[at])), where, pa.array(np.full(len(at), size, dtype=np.int32)), pa.array(np.full(len(at), exact)), values]
                        yield pa.RecordBatch.from_arrays(columns, ["hash", key, "place", "size", "exact", "slots"])

    rows = texts.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"hash long, {key} long, place long, size int, exact boolean, slots array<long>")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contaminated documents of docs(doc_id, text): the items of benchmark(item_id, text) found in them.

    doc_id, item_ids (ascending), n_windows (windows found over all items) and reparameterised (a value was exchanged).
    Documents without a passage of the benchmark give no row, and rows that share a doc_id give one.  Null and empty
    texts and items, and items without a word, are never found; an empty benchmark gives no rows; long texts are searched
    whole.  Other columns, of either table, are not looked at.  An item is in a document if enough of its templates are, or enough of its windows word for word (for an
    item of few words: all of it), capitals and punctuation aside.
    """
    items = written(window_rows(benchmark, "item_id", tuple(range(1, WINDOW + 1)), True, None), "benchmark_windows")
    sizes = tuple(sorted(r[0] for r in items.select("size").distinct().collect()))
    items = items.select("hash", "item_id", "exact", F.col("slots").alias("values"), F.col("place").alias("item_place"))
    hashes = items.select("hash").distinct()
    known = None
    if (n := hashes.count()) <= SENT_HASHES:
        known = np.sort(hashes.toArrow().column("hash").to_numpy().view(U64)) if n else np.zeros(0, dtype=U64)
    found = window_rows(docs, "doc_id", sizes, False, known).drop("size", "exact")
    need = items.groupBy("item_id", "exact").agg(F.least(F.lit(LEAST_WINDOWS), F.countDistinct("item_place")).alias("need"))
    right = written(items.join(need, ["item_id", "exact"]), "benchmark_items")
    pairs = found.join(F.broadcast(right) if right.count() <= SENT_ROWS else right, "hash")
    # windows of one copy; each place of the item is there once, so the sets are bounded by the item's length
    both = F.array_distinct(F.arrays_zip(F.col("slots").alias("a"), F.col("values").alias("b")))
    copies = pairs.groupBy("doc_id", "item_id", "exact", (F.col("place") - F.col("item_place")).alias("shift")).agg(
        F.array_distinct(F.flatten(F.collect_set(both))).alias("both"), F.collect_set("item_place").alias("places"), F.max("need").alias("need"),
        F.max(F.coalesce(F.col("slots") != F.col("values"), F.lit(False))).alias("changed"),
    )
    copies = copies.where(F.size("both") == F.size(F.array_distinct("both.b")))
    count = lambda places: F.size(F.array_distinct(F.flatten(F.collect_list(places)))).cast("long")
    hits = copies.groupBy("doc_id", "item_id").agg(
        count("places").alias("windows"),
        *(count(F.when(F.col("exact") == e, F.col("places"))).alias(f"n_{e}") for e in (True, False)),
        *(F.max(F.when(F.col("exact") == e, F.col("need"))).alias(f"need_{e}") for e in (True, False)),
        F.max("changed").alias("changed"),
    )
    return hits.where("n_True >= need_True or n_False >= need_False").groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.sum("windows").alias("n_windows"), F.max("changed").alias("reparameterised")
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(*(table(spark, sf_dir, t) for t in ("documents", "benchmark")))
