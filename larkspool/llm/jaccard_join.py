"""Exact n-gram Jaccard join of whole texts, and the groups that its links make.

Sets of word shingles are indexed as ``partition_index`` describes; texts that meet under a key are candidates.  Texts
with equal sets are one node from the start.  Groups of near copies would give pairs with the square of their size, so
links are found in two steps: first every node of a key is compared with the key's most central node only, then the
nodes that are still in different components.  That join gives a pair under the first key that it shares, and rarely under
others, and only if a lower bound of the sets' difference (parities of the elements in fixed cells) allows a link; a finer
one is tested on the pairs, and what is left is verified on the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from . import partition_index as X
from .components import components
from .scratch import forget, table, written

U64 = np.uint64
#: Longs of parity cells for each set: those that the join of pairs carries, and those that pairs are tested by before their texts.
PARITIES, FINE = 8, 32
#: A list of node ids up to this many (8 bytes each) is broadcast to pick texts; a longer one is joined by shuffling.
BROADCAST_IDS = 500_000
#: Segments before its own that an entry tells the keys of, so that most pairs are given under one of their keys only.
BACK = 12
#: Bits of the filter that is sent to every task, as a power of two: 8 MB whatever the number of keys.
FILTER_BITS = 26
#: Keys up to which what passes the filter is nearly all theirs, and is not joined with them again.
FILTER_KEYS = 4_000_000
#: A table of nodes with a number or two of each up to this many (50 bytes each) is broadcast; a longer one is shuffled.
BROADCAST_NODES = 250_000


@dataclass(frozen=True)
class Jaccard:
    """Shingles of ``size`` words; linked if 100 * intersection >= percent * union."""

    size: int = 5
    percent: int = 80


def _sets(part: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = K.buffers(part.column(1))
    w = K.words(K.LOWER[data], offsets)
    return X.shingles(w.hashes(), w, size)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _parities(doc: np.ndarray, shingle: np.ndarray, docs: int, longs: int) -> np.ndarray:
    """Bits that say in which of 64 * longs cells a set has an odd number of elements."""
    cell = (K.mix(shingle ^ U64(0x2545F4914F6CDD1D)) % U64(64 * longs)).astype(np.int64)
    odd = np.bincount(doc * (64 * longs) + cell, minlength=docs * 64 * longs) & 1
    return np.packbits(odd.astype(np.uint8).reshape(docs, longs, 64), axis=2).view(np.int64).reshape(docs, longs)


def node_rows(docs: DataFrame, how: Jaccard) -> DataFrame:
    """doc_id, size of the set, its digest and its finer parities."""
    names = ["doc_id", "n_shingles", "sig", "fine"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                doc, shingle = _sets(part, how.size)
                n, sig = X.signatures(doc, shingle, part.num_rows)
                fine = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * FINE), pa.array(_parities(doc, shingle, part.num_rows, FINE).ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), K.signed(sig), fine], names)

    return _texts(docs).mapInArrow(run, ", ".join(f"{x} long" for x in names[:-1]) + ", fine array<long>")


def key_rows(docs: DataFrame, how: Jaccard, filled: np.ndarray | None = None) -> DataFrame:
    """(key, sig) of every index entry; with a filter (``key_filter``) only of those whose key may be in it, and their (band, bound)."""
    sent = docs.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                doc, shingle = _sets(part, how.size)
                _, sig = X.signatures(doc, shingle, part.num_rows)
                e = X.index_keys(doc, shingle, part.num_rows, how.percent)
                if sent.value is None:
                    yield pa.RecordBatch.from_arrays([K.signed(e.key), K.signed(sig[e.doc])], ["key", "sig"])
                    continue
                held = _held(sent.value, e.key)
                yield pa.RecordBatch.from_arrays([K.signed(e.key[held]), K.signed(sig[e.doc[held]]), pa.array(e.band[held]), pa.array(e.bound[held])], ["key", "sig", "band", "bound"])

    return _texts(docs).mapInArrow(run, "key long, sig long" + ("" if filled is None else ", band int, bound int"))


def _held(filled: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each key."""
    return (filled[key >> U64(64 - FILTER_BITS + 6)] >> (key >> U64(64 - FILTER_BITS) & U64(63))) & U64(1) == 1


def meeting_rows(nodes: DataFrame, how: Jaccard, filled: np.ndarray) -> DataFrame:
    """Index entries of nodes(sig, text, component, bands) in those bands, under keys that the filter may hold.

    key, sig, component, size and parities of the set, and q0.. of ``partition_index.earlier_keys``.
    """
    sent = nodes.sparkSession.sparkContext.broadcast(filled)
    names = ["key", "sig", "component", "n_shingles", *(f"p{i}" for i in range(PARITIES)), *(f"q{i}" for i in range(BACK + 1))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                doc, shingle = _sets(part, how.size)
                e = X.index_keys(doc, shingle, part.num_rows, how.percent)
                own = [(i, b) for i, bands in enumerate(part.column(3).to_pylist()) for b in bands]
                wanted = np.array([(i << 20) + b + (1 << 19) for i, b in own], dtype=np.int64)
                keep = np.flatnonzero(np.isin((e.doc.astype(np.int64) << 20) + e.band + (1 << 19), wanted) & _held(sent.value, e.key))
                at = e.doc[keep]
                size = np.bincount(doc, minlength=part.num_rows).astype(np.int64)
                bits, before = _parities(doc, shingle, part.num_rows, PARITIES), X.earlier_keys(e, BACK)
                columns = [K.signed(e.key[keep]), part.column(0).take(pa.array(at)), part.column(2).take(pa.array(at)), pa.array(size[at])]
                columns += [pa.array(bits[at, i]) for i in range(PARITIES)] + [K.signed(before[keep, j].copy()) for j in range(BACK + 1)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return nodes.select("sig", "text", "component", "bands").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit for each of keys(key), by its first bits; Spark fills it word by word.

    The more keys, the more others pass; what passes is joined with the keys afterwards.
    """
    word = F.shiftrightunsigned("key", 64 - FILTER_BITS + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - FILTER_BITS}) & 63 as int))")
    words = keys.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=U64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(U64)
    return out


def _may_link(how: Jaccard, a: str, b: str, differ: Column) -> Column:
    """Sizes and a lower bound of the difference allow the similarity; never false for a true link."""
    p = how.percent
    x, y = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    # 100 i >= p (x + y - i) and the difference is x + y - 2 i
    return (100 * F.least(x, y) >= p * F.greatest(x, y)) & ((100 + p) * differ <= (100 - p) * (x + y))


def _coarse(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(f"{a}.p{i}").bitwiseXOR(F.col(f"{b}.p{i}"))) for i in range(PARITIES)), F.lit(0))


def _fine(a: str, b: str) -> Column:
    bits = F.zip_with(F.col(f"{a}.fine"), F.col(f"{b}.fine"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda s, x: s + x)


def _likely(pairs: DataFrame, of: DataFrame, how: Jaccard) -> DataFrame:
    """The pairs(u, v) that the finer parities allow."""
    fine = of.select("sig", "n_shingles", "fine")
    a, b = fine.select(F.col("sig").alias("u"), F.struct("n_shingles", "fine").alias("a")), fine.select(F.col("sig").alias("v"), F.struct("n_shingles", "fine").alias("b"))
    return pairs.join(a, "u").join(b, "v").where(_may_link(how, "a", "b", _fine("a", "b"))).select("u", "v")


def _verified(pairs: DataFrame, texts: DataFrame, how: Jaccard) -> DataFrame:
    """The pairs(u, v) of nodes whose texts have the similarity."""
    left, right = texts.select(F.col("sig").alias("u"), F.col("text").alias("a")), texts.select(F.col("sig").alias("v"), F.col("text").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets_of(column):
            data, offsets = K.buffers(column)
            w = K.words(K.LOWER[data], offsets)
            doc, shingle = X.shingles(w.hashes(), w, how.size)
            return shingle, np.searchsorted(doc, np.arange(len(column) + 1))

        for batch in batches:
            for part in K.slices(batch, "a"):
                (sa, fa), (sb, fb) = sets_of(part.column(2)), sets_of(part.column(3))
                keep = []
                for i in range(part.num_rows):
                    a, b = sa[fa[i] : fa[i + 1]], sb[fb[i] : fb[i + 1]]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= how.percent * (len(a) + len(b) - both))
                yield part.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """sig and text of the documents in ids(doc_id, sig)."""
    small = ids.count() <= BROADCAST_IDS
    return _texts(docs).join(F.broadcast(ids) if small else ids, "doc_id").groupBy("sig").agg(F.first("text").alias("text"))


def _kept(members: DataFrame) -> DataFrame:
    """(key, sig, band, c) of the entries that sets can meet under: c sets have the key, two at least.

    A set that is similar to another shares ``bound`` keys of a band with it at least, so one that shares fewer with all
    others together is similar to none there (as a text that only has some lines in common with others).
    """
    able = members.groupBy("sig", "band").agg(F.count("*").alias("n"), F.max("bound").alias("bound")).where("n >= bound").select("sig", "band")
    left = written(members.select("key", "sig", "band").join(written(able, "jaccard_able"), ["sig", "band"], "left_semi"), "jaccard_left")
    sizes = written(left.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "jaccard_sizes")
    out = written(left.join(sizes, "key").select("key", "sig", "band", "c"), "jaccard_kept")
    forget(left, sizes)
    return out


def links(docs: DataFrame, nodes: DataFrame, how: Jaccard) -> tuple[DataFrame, DataFrame]:
    """Links between nodes that connect whatever is linked, as (u, v); and (node, component) of the nodes that have any."""
    keys = key_rows(docs, how)
    shared = keys.groupBy("key").agg(F.min("sig").alias("a"), F.max("sig").alias("b")).where("a <> b").select("key")
    shared = written(shared, "jaccard_keys")
    members = written(key_rows(docs, how, key_filter(shared)).join(shared, "key", "left_semi").distinct(), "jaccard_members")
    kept = _kept(members)
    forget(shared, members)
    # the more and the larger the keys of a node, the more of its group it can stand for
    central = written(kept.groupBy("sig").agg(F.sum("c").alias("central")), "jaccard_central")
    known = nodes.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n_shingles", "fine")))
    of = written(known.join(central, "sig"), "jaccard_nodes")
    small = of.count() <= BROADCAST_NODES
    texts = written(_picked(docs, of.select("doc_id", "sig")), "jaccard_texts")

    def with_nodes(rows: DataFrame, *columns: str) -> DataFrame:
        table = of.select("sig", *columns)
        return rows.join(F.broadcast(table) if small else table, "sig")

    # written, so that both sides of the next join are plain exchanges and hot keys can be split
    pivots = written(with_nodes(kept, "central").groupBy("key").agg(F.max(F.struct("central", "sig")).alias("b")).select("key", F.col("b.sig").alias("v")), "jaccard_pivots")
    star = kept.join(pivots, "key").where("sig <> v").select(F.col("sig").alias("u"), "v").distinct()
    star = written(_likely(star, of, how), "jaccard_star")
    found = written(_verified(star, texts, how), "jaccard_links")
    linked = components(found)
    parts = linked.withColumnRenamed("node", "sig")
    forget(central, pivots, star)

    small_parts = parts.count() <= BROADCAST_NODES
    rest = kept.join(F.broadcast(parts) if small_parts else parts, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    open_keys = written(rest.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key"), "jaccard_open")
    held = rest.join(open_keys, "key", "left_semi").groupBy("sig").agg(F.min("component").alias("component"), F.collect_set("band").alias("bands"))
    held = written(held, "jaccard_held")
    meet = meeting_rows(texts.join(F.broadcast(held) if small else held, "sig"), how, key_filter(open_keys))
    if open_keys.count() > FILTER_KEYS:
        meet = meet.join(open_keys, "key", "left_semi")
    meet = written(meet, "jaccard_meet")
    apart = (F.col("a.key") == F.col("b.key")) & (F.col("a.sig") < F.col("b.sig")) & (F.col("a.component") != F.col("b.component"))
    met = reduce(Column.__or__, (F.col(f"a.q{j}") == F.col(f"b.q{j}") for j in range(BACK + 1)))
    more = meet.alias("a").join(meet.alias("b"), apart & ~met & _may_link(how, "a", "b", _coarse("a", "b")))
    more = written(more.select(F.col("a.sig").alias("u"), F.col("b.sig").alias("v")).distinct(), "jaccard_more")
    likely = written(_likely(more, of, how), "jaccard_likely")
    first, found = found, written(found.unionByName(_verified(likely, texts, how)), "jaccard_links")
    forget(kept, of, texts, linked, open_keys, held, meet, more, likely, first)
    return found, components(found)


def jaccard_groups(docs: DataFrame, how: Jaccard = Jaccard()) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row of docs(doc_id, text).

    Words are separated by ASCII white space and compared with A-Z lowered.  A text of fewer words than a shingle is one
    shingle; null, empty and blank texts have none and are their own component.  Repeated rows give repeated rows.  Sets
    are compared by 64-bit digests of their shingles; long texts are read whole.  An empty table gives no rows.  Other columns
    are not looked at.
    """
    nodes = written(node_rows(docs, how), "jaccard_sets")
    found, parts = links(docs, nodes, how)
    least = nodes.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    named = least.join(parts.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    named = written(named, "jaccard_named")
    ids = written(named.groupBy("component").agg(F.min("least").alias("component_id")), "jaccard_ids")  # large groups can then be split
    of_sig = written(named.join(ids, "component").select("sig", "component_id"), "jaccard_components")
    forget(found, parts, named, ids)
    return nodes.join(of_sig, "sig", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), Jaccard(size=3, percent=90))


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], chr(0)) AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- of documents with equal sets one stands for all
sets AS (SELECT doc_id, string_agg(sh, chr(1) ORDER BY sh) AS k FROM s GROUP BY doc_id),
same AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS rep FROM sets),
r AS (SELECT s.* FROM s JOIN same USING (doc_id) WHERE doc_id = rep),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM r a JOIN r b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 90 * (p.n + q.n - i)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT x, x AS y FROM edge UNION SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x),
part AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, rep, w.doc_id) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN same ON same.doc_id = w.doc_id LEFT JOIN part ON part.x = same.rep
"""
