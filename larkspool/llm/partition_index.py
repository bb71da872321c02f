"""Index keys of the exact set-similarity join: universe partitions, one-deletion neighbourhoods, cost-based allocation.

Two sets x, y with |x| <= |y| and Jaccard >= p/100 differ in at most U <= (100-p)/p * |x| elements.  Elements are hashed
into the segments of a size band; if u > U segments are compared, one of them is equal in both sets, and if every segment
also gives its one-deletion neighbourhood, u > U/2 do.  A band takes the cheaper of the two (``Band``): exact segments
cost one key each, neighbourhoods cost a key for each element but keep the segments of small sets large and so selective.
A set uses only the first ``used(n)`` segments of its band (the others are allocated no threshold) and also gives keys to
the next band if a partner can be there.

Empty segments would be equal in unrelated sets, so they get no key.  What this could lose is caught elsewhere:

* exact bands: ``spare`` segments more are used than needed.  A pair that is lost has more than ``spare`` segments empty
  in both; such sets also give the one-deletion neighbourhoods of all their segments.  If that fails too, over half of
  the segments hold one element at most in both, and such sets meet under a key of their own.
* neighbourhood bands: a pair that is lost has two segments that hold one element at most in both (one segment is spare),
  so the sets meet under a key of those two.  Bands of one segment lose nothing.

Spare segments say more: of the segments that two similar sets of an exact band compare, ``spare`` + 1 at least are equal,
and no more of them are empty in both than either set has empty ones.  So the two share ``spare`` + 1 - empties keys at least,
whichever of the two counts its empties.  ``index_keys`` returns this bound with each key; a set that shares fewer keys of a
band with all others together is similar to none there.

Similar sets, and sets that nearly are, share many keys.  ``earlier_keys`` says for each key which keys of whole segments the
set has in the segments before; two sets that share one of those need not be compared under this key, for they meet under
that one as well, and of all keys that they share the first is never passed over.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from . import kernels as K

U64 = np.uint64
#: Sets below this size are indexed by one-deletion neighbourhoods: their exact segments would be few and unselective.
DELETION_BELOW = 128
RATIO = 1.5


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int
    deletions: bool
    spare: int
    percent: int

    def need(self, n):
        return ((100 - self.percent) * n) // self.percent + 1

    def used(self, n):
        if self.deletions:
            half = (self.need(n) + 1) // 2
            return half + self.spare * (self.segments_plain > 1)
        return self.need(n) + self.spare

    @property
    def segments_plain(self) -> int:
        return (self.need(self.high) + 1) // 2

    @property
    def segments(self) -> int:
        return int(self.used(self.high))


@lru_cache(maxsize=8)
def bands(percent: int, largest: int) -> list[Band]:
    """Bands up to the size ``largest``; neighbours differ by the factor 100/percent at least."""
    out, low, ratio = [], 1, max(RATIO if percent >= 88 else 1.25, 100 / percent)
    while low <= largest or not out or out[-1].high < largest:
        high = max(low, int(np.ceil(low * ratio)) - 1)
        deletions = low < DELETION_BELOW
        spare = 1
        if not deletions:
            plain = (100 - percent) * high // percent + 1
            fill = low / (plain * 1.1 + 3)
            mean = plain * np.exp(-fill)
            spare = int(np.ceil(mean + 3 * np.sqrt(mean) + 1))
        out.append(Band(len(out), low, high, deletions, spare, percent))
        low = high + 1
    return out


def _salt(band: np.ndarray, segment: np.ndarray, kind: int) -> np.ndarray:
    return K.mix((band.astype(U64) << U64(40)) ^ (segment.astype(U64) << U64(4)) ^ U64(kind))


def signatures(doc: np.ndarray, shingle: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit digest of each text's set (doc ascending, shingles distinct); empty sets have the digest 0."""
    n = np.bincount(doc, minlength=docs)
    total = np.zeros(len(doc) + 1, dtype=U64)
    np.cumsum(K.mix(shingle ^ U64(0x5851F42D4C957F2D)), out=total[1:])
    first = np.concatenate([[0], np.cumsum(n)])
    digest = K.mix(total[first[1:]] - total[first[:-1]] + n.astype(U64))
    return n, np.where(n > 0, digest, U64(0))


#: Kinds of entries: a whole segment, a segment without one element, and others, which are in no segment.
WHOLE, LESS, OTHER = 0, 1, 2


@dataclass(frozen=True)
class Entries:
    """Index entries: set, key, band, how many keys of the band a similar set shares at least, kind and segment."""

    doc: np.ndarray
    key: np.ndarray
    band: np.ndarray
    bound: np.ndarray
    kind: np.ndarray
    segment: np.ndarray


def earlier_keys(e: Entries, back: int) -> np.ndarray:
    """A row for each entry: the key of its whole segment (unless it is that), and of the ``back`` segments before.

    Where there is none, as of empty segments, stands a number that no other set has there.
    """
    place = (e.doc.astype(np.int64) << 40) ^ ((e.band.astype(np.int64) & 0xFFF) << 28)
    whole = np.flatnonzero(e.kind == WHOLE)
    at = place[whole] + e.segment[whole]
    order = np.argsort(at)
    at, key = at[order], e.key[whole][order]
    out = K.mix(e.key ^ (e.doc.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))[:, None] + np.arange(back + 1, dtype=U64)
    for j in range(back + 1):
        wanted = place + e.segment - j
        there = (e.segment >= j) & (e.kind != OTHER) & ((e.kind == LESS) | (j > 0))
        if len(at):
            found = np.minimum(np.searchsorted(at, wanted), len(at) - 1)
            there &= at[found] == wanted
            out[there, j] = key[found[there]]
    return out


def index_keys(doc: np.ndarray, shingle: np.ndarray, docs: int, percent: int) -> Entries:
    """Every index entry of the sets; ``doc`` ascending, shingles distinct within a doc.  A key is in one band only."""
    n = np.bincount(doc, minlength=docs)
    if not len(doc):
        none = np.zeros(0, dtype=np.int64)
        return Entries(none, none.astype(U64), none, none, none, none)
    table = bands(percent, max(64, 1 << int(n.max() * 100 // percent + 1).bit_length()))
    highs = np.array([b.high for b in table])
    own = np.searchsorted(highs, n)
    following = np.searchsorted(highs, n * 100 // percent)
    parts = []

    def give(of, key, band, bound, kind, segment):
        parts.append((of, key, band.astype(np.int32), np.broadcast_to(bound, len(of)).astype(np.int32), np.full(len(of), kind, dtype=np.int8), segment.astype(np.int32)))

    for which, band_of in ((0, own), (1, following)):
        chosen = (n > 0) & ((band_of > own) if which else True)
        mine = chosen[doc]
        if not mine.any():
            continue
        d, h = doc[mine], shingle[mine]
        at = np.minimum(band_of, len(table) - 1)
        segments = np.array([b.segments for b in table])[at]
        used = np.array([b.used(int(x)) for b, x in zip((table[i] for i in at), n, strict=True)])
        smallest = -(-percent * n // 100)
        used_low = np.array([b.used(int(x)) for b, x in zip((table[i] for i in at), smallest, strict=True)])
        deletes = np.array([b.deletions for b in table])[at]
        spare = np.array([b.spare for b in table])[at]
        first = np.concatenate([[0], np.cumsum(np.where(chosen, used, 0))])
        r = K.mix(h ^ _salt(at[d], np.zeros(len(d), dtype=np.int64), 1))
        segment = (((r >> U64(32)) * segments[d].astype(U64)) >> U64(32)).astype(np.int64)
        keep = segment < used[d]
        d, h, segment = d[keep], K.mix(h[keep] ^ U64(0xD1342543DE82EF95)), segment[keep]
        cell = first[d] + segment
        order = np.argsort(cell, kind="stable")
        d, h, segment, cell = d[order], h[order], segment[order], cell[order]
        size = np.bincount(cell, minlength=first[-1])
        total = np.zeros(len(h) + 1, dtype=U64)
        np.cumsum(h, out=total[1:])
        end = np.cumsum(size)
        content = total[end] - total[end - size]
        owner = np.repeat(np.arange(docs), np.where(chosen, used, 0))
        number = np.arange(first[-1]) - first[owner]
        full = size > 0
        salt = _salt(at[owner], number, 2)
        empties = np.bincount(owner[~full], minlength=docs)
        bound = np.where(deletes, 1, np.maximum(1, spare + 1 - empties))
        give(owner[full], K.mix(content[full] ^ salt[full]), at[owner[full]], bound[owner[full]], WHOLE, number[full])
        thin = np.bincount(owner[size <= 1], minlength=docs)
        near = deletes | (empties > spare)
        take = near[d] & (size[cell] > 1)
        give(d[take], K.mix((content[cell[take]] - h[take]) ^ salt[cell[take]]), at[d[take]], 1, LESS, number[cell[take]])
        crowded = np.flatnonzero(chosen & ~deletes & (2 * thin > used_low))
        # a key of its own kind, as a band of its own: it is no part of what the bound counts
        give(crowded, _salt(at[crowded], np.zeros(len(crowded), dtype=np.int64), 3), -1 - at[crowded], 1, OTHER, np.zeros(len(crowded)))
        for x in np.flatnonzero(chosen & deletes & (used > 1) & (thin > 1)):
            cells = np.flatnonzero(size[first[x] : first[x + 1]] <= 1)
            i, j = np.triu_indices(len(cells), 1)
            pair = cells[i] * 4096 + cells[j]
            give(np.full(len(pair), x), _salt(np.full(len(pair), at[x]), pair, 4), np.full(len(pair), at[x]), 1, OTHER, np.zeros(len(pair)))
    return Entries(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def shingles(hashes: np.ndarray, w: K.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, shingle) without repeats, doc ascending; a text of fewer words gives its whole sequence as one shingle."""
    h, at = K.windows(hashes, w, size)
    doc = w.doc[at]
    counts = w.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = K.mix(K.spans_hash(hashes, w.first[short], w.first[short + 1], K.WORD_BASES[0]) + counts[short].astype(U64))
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]
