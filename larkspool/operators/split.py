"""Splitting long texts into overlapping parts, inside each row: no shuffle, whatever the number of parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import Limits

#: A sentence ends at . ? or ! after a small letter, a digit or a closing bracket; the blanks behind it go.
SENTENCE_END = r"(?<=[a-z0-9)\]][.?!])\s+"


def _numbered(texts: Column) -> Column:
    """Items that hold more than spaces, with their places before that filter."""
    return F.filter(F.transform(texts, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: F.length(F.trim(s["x"])) > 0)


def atoms(text: Column, limits: Limits = Limits()) -> Column:
    """Pieces that parts are packed from: sentences, cut at the target, each behind one separator character.

    The separator is a line break for the first piece of a later line, else a space.
    """

    def pieces(line, sentence):
        last = F.floor((F.length(sentence["x"]) - 1) / limits.target).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.concat(
                F.when((line["i"] > 0) & (sentence["i"] == 0) & (k == 0), F.lit("\n")).otherwise(F.lit(" ")),
                F.substring(sentence["x"], k * limits.target + 1, F.lit(limits.target)),
            ),
        )

    def of_line(line):
        return F.flatten(F.transform(_numbered(F.split(line["x"], SENTENCE_END)), lambda s: pieces(line, s)))

    return F.flatten(F.transform(_numbered(F.split(text, "\n")), of_line))


def packed(pieces: Column, limits: Limits = Limits()) -> Column:
    """Parts filled from left to right up to the target; the separator before a part is dropped."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def put(state, piece):
        fits = F.length(state["open"]) + F.length(piece) <= limits.target
        fresh = F.substring(piece, 2, limits.target)
        return (
            F.when(state["open"] == "", F.struct(state["done"].alias("done"), fresh.alias("open")))
            .when(fits, F.struct(state["done"].alias("done"), F.concat(state["open"], piece).alias("open")))
            .otherwise(F.struct(F.array_append(state["done"], state["open"]).alias("done"), fresh.alias("open")))
        )

    return F.aggregate(pieces, empty, put, lambda s: F.when(s["open"] == "", s["done"]).otherwise(F.array_append(s["done"], s["open"])))


def overlapped(parts: Column, limits: Limits = Limits()) -> Column:
    """Each later part behind the end of the one before, from that end's first space on where it has one."""

    def joined(part, i):
        tail = F.right(F.get(parts, i - 1), F.lit(limits.overlap))
        space = F.instr(tail, " ")
        return F.when(i == 0, part).otherwise(F.concat(F.when(space > 0, F.substring(tail, space + 1, F.length(tail))).otherwise(tail), F.lit("\n"), part))

    return F.transform(parts, joined)


def split_parts(units: DataFrame, keys: Sequence[str], text: str, where: Column | None = None, limits: Limits = Limits(), carry: Sequence[str] = ()) -> DataFrame:
    """keys, part_no (from 0), total_parts, part_text, part_char_count, and the columns of ``carry``.

    Only rows that fulfil ``where`` are split; null texts and texts of blanks give no parts.  Parts never exceed the
    target before the overlap.
    """
    rows = units if where is None else units.where(where)
    # two projections with the parts between them: the overlap reads each part twice, the packing runs once
    rows = rows.select(*keys, *carry, packed(atoms(F.col(text), limits), limits).alias("_parts"))
    rows = rows.select(*keys, *carry, F.size("_parts").alias("total_parts"), F.posexplode(overlapped(F.col("_parts"), limits)).alias("part_no", "part_text"))
    return rows.select(*keys, "part_no", "total_parts", "part_text", F.length("part_text").alias("part_char_count"), *carry)
