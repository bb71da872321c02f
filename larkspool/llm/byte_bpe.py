"""Byte-level BPE: exact encoding by backtracking over longest matches, and decoding.

Bytes are mapped to Latin-1 characters so that one Aho-Corasick automaton finds every token that starts at each byte of
a piece.  A sequence of tokens is the encoding of its bytes exactly if every two neighbours are: merging the bytes of the
pair gives the pair again.  Encoding takes the longest token that is compatible with its predecessor and backtracks where
none is; positions that led nowhere are remembered, so a piece costs time linear in its length.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .scratch import table

#: White space by Unicode, written out: the engines' \s differ in the ASCII separators.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Encoded pieces remembered by a worker, twice as many at most (see ``_Pieces``); neighbours are forgotten when they are more.
PIECES_KEPT = 250_000
#: Pieces longer than this are not remembered.
LONGEST_KEPT = 40


def explicit_pattern(pattern: str) -> str:
    """The pattern with its white-space classes written out (inside and outside brackets)."""
    return pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")


#: Texts of characters below this one are split by the standard library's faster engine.
_LATIN_END = 0x250


def latin_pattern(pattern: str) -> str:
    """``explicit_pattern`` with the classes of letters and numbers written out for the characters below ``_LATIN_END``."""
    of = {k: "".join(re.escape(chr(c)) for c in range(_LATIN_END) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    out = explicit_pattern(pattern)
    for k, members in of.items():
        while rf"\p{{{k}}}" in out:  # in a class of its own, or after other members of one
            at = out.index(rf"\p{{{k}}}")
            inside = out.rfind("[", 0, at) > out.rfind("]", 0, at)
            out = out[:at] + (members if inside else f"[{members}]") + out[at + 5 :]
    return out


class _Pieces(dict):
    """Ids by piece.  A piece that is not there is encoded; when the memory is full it becomes the old one, from which pieces
    that come again are taken over."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        got = self.old.get(piece) or self.encode(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= PIECES_KEPT:
                self.old = dict(self)
                self.clear()
            self[piece] = got
        return got


class ByteBPE:
    """Encoder and decoder for a rank file (base64 token and rank on each line)."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.split = regex.compile(explicit_pattern(pattern)).findall
        self.split_latin = re.compile(latin_pattern(pattern)).findall
        self.other = re.compile(f"[^\\x00-{chr(_LATIN_END - 1)}]").search
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            if len(token) == 1 or self._merge(token) == [i]:  # a token that merging never makes is no candidate
                self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces = _Pieces(self._encode_piece)

    def _merge(self, data: bytes) -> list[int]:
        """Reference merging of a few bytes: the lowest rank first, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _compatible(self, a: int, b: int) -> bool:
        got = self.pairs.get(key := a << 32 | b)
        if got is None:
            if len(self.pairs) >= PIECES_KEPT:
                self.pairs.clear()
            got = self.pairs[key] = self._merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return got

    def _backtrack(self, data: bytes) -> list[int]:
        n = len(data)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (size, i) in self.automaton.iter(data.decode("latin-1")):
            starts[end - size + 1].append((size, i))  # ends ascend, so sizes do
        out: list[int] = []
        at, choice = 0, [len(starts[0])]
        dead: set[tuple[int, int]] = set()  # (start, token) from which the end can't be reached
        places = [0]
        while at < n:
            while choice[-1]:
                choice[-1] -= 1
                size, i = starts[at][choice[-1]]
                if (at, i) not in dead and (not out or self._compatible(out[-1], i)):
                    out.append(i)
                    at += size
                    places.append(at)
                    choice.append(len(starts[at]) if at < n else 0)
                    break
            else:
                choice.pop()
                places.pop()
                at = places[-1]
                dead.add((at, out.pop()))
        return out

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else tuple(self._backtrack(data))

    def encode(self, text: str) -> list[int]:
        pieces = (self.split if self.other(text) else self.split_latin)(text)
        return list(chain.from_iterable(map(self.pieces.__getitem__, pieces)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path of a public rank file and the pattern that splits texts for it."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


_coders: dict[tuple[str, str], ByteBPE] = {}


def coder(rank_file: str, pattern: str) -> ByteBPE:
    """One coder for each process; the automaton is built once."""
    if (rank_file, pattern) not in _coders:
        _coders[rank_file, pattern] = ByteBPE(rank_file, pattern)
    return _coders[rank_file, pattern]


def encode_table(docs: DataFrame, rank_file: str | None = None, pattern: str | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (array of int, if ``keep_ids``), ids_sha256 and decoded_sha256 of every whole text.

    Null counts as empty: no tokens, and the digests of nothing.  An empty table gives no rows, and every row one, repeated
    ones too.  Texts of
    any length are encoded piece by piece.  Other columns are not looked at.
    """
    if rank_file is None or pattern is None:
        rank_file, pattern = vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        bpe = coder(rank_file, pattern)
        names = {i: str(i) for i in bpe.tokens}
        for batch in batches:
            for part in K.slices(batch, "text"):
                rows = []
                for text in part.column(1).to_pylist():
                    ids = bpe.encode(text or "")
                    said = sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest()
                    rows.append((len(ids), said, sha256(bpe.decode(ids)).hexdigest(), ids))
                columns = [part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
                fields = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.array([r[3] for r in rows], pa.list_(pa.int32())))
                    fields.append("ids")
                yield pa.RecordBatch.from_arrays(columns, fields)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def decode_table(encoded: DataFrame, rank_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and text of ``encoded(doc_id, ids)``; null ids give a null text, bytes that are no UTF-8 become U+FFFD."""
    if rank_file is None or pattern is None:
        rank_file, pattern = vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(rank_file, pattern)
        for batch in batches:
            texts = [None if ids is None else bpe.decode(ids).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_table(table(spark, sf_dir, "documents"), keep_ids=False)
