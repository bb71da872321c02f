"""Column expressions that several operators must agree on to the character."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """Characters (code points) that a chunk may have, that a part aims at, and that parts share."""

    ceiling: int = 2000
    target: int = 1200
    overlap: int = 200

    @property
    def longest_part(self) -> int:
        return self.target + self.overlap + 2


#: Fixed value: sections that are indexed elsewhere or only restate typed columns.
UNINDEXED_SECTIONS = ("routine_uses", "system_name_and_number", "system_name", "security_classification")


def non_blank(text: Column) -> Column:
    """Holds more than spaces; tabs and line breaks count as text, null does not."""
    return text.isNotNull() & (F.length(F.trim(text)) > 0)


def heading_line(title: Column, agency: Column) -> Column:
    return F.concat(title, F.lit(" ("), F.coalesce(agency, F.lit("Unknown agency")), F.lit(")"))


def chunk_text(title: Column, agency: Column, heading: Column, body: Column) -> Column:
    """Text that is embedded; a null piece is left out together with its blank line."""
    return F.concat_ws("\n\n", heading_line(title, agency), heading, body)


def is_oversized(title: Column, agency: Column, heading: Column, body: Column, limits: Limits = Limits()) -> Column:
    """Measured on the assembled text, never on the body alone."""
    return F.length(chunk_text(title, agency, heading, body)) > limits.ceiling


def is_indexable(section_key: Column) -> Column:
    return ~section_key.isin(*UNINDEXED_SECTIONS)


def part_label(label: Column, part_no: Column, total: Column) -> Column:
    return F.concat(label, F.lit(" (part "), (part_no + 1).cast("string"), F.lit(" of "), total.cast("string"), F.lit(")"))


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def size_or_zero(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0))


#: Date formats in the order they are tried.
DATE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "yyyy-MM-dd", "M/d/yyyy")


def iso_date(text: Column) -> Column:
    """A written date as yyyy-MM-dd, else null; blanks around it and full stops after it don't matter."""
    plain = F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\.+$", "")
    return F.date_format(F.coalesce(*(F.try_to_date(plain, f) for f in DATE_FORMATS)), "yyyy-MM-dd")


#: What an action line contains, first match first, and the kind of action.
ACTION_KINDS = (
    (("rescind",), "rescindment"),
    (("modif", "amend"), "modified"),
    (("updat", "reissu"), "updated"),
    (("new",), "new"),
    (("notice",), "notice"),
)


def action_kind(text: Column) -> Column:
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit("unknown")
    for words, kind in reversed(ACTION_KINDS):
        out = F.when(low.rlike("|".join(words)), kind).otherwise(out)
    return out


def _stripped(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))


def is_hard_wrapped(lines: Column) -> Column:
    """Lines broken at a fixed width: 20 or more, upper median 50 to 85 characters, under 45 % ending in punctuation."""
    body = F.filter(_stripped(lines), lambda x: x != "")
    sizes = F.array_sort(F.transform(body, F.length))
    median = F.get(sizes, F.floor(F.size(body) / 2).cast("int"))
    ended = F.size(F.filter(body, lambda x: x.rlike(r"[.:;!?]$")))
    return F.coalesce((F.size(body) >= 20) & median.between(50, 85) & (ended < 0.45 * F.size(body)), F.lit(False))


def reflowed(lines: Column, hard: Column) -> Column:
    """Wrapped lines joined into paragraphs (ended by blank lines), other lines kept one by one; blank edges go."""
    plain = _stripped(lines)
    marked = F.array_join(F.transform(plain, lambda x: F.when(x == "", F.lit("\u0001")).otherwise(x)), "\u0002")
    # \u0001 stands for a blank line and \u0002 for a line break until both are resolved
    paragraphs = F.regexp_replace(F.regexp_replace(F.regexp_replace(marked, "\u0002?(\u0001\u0002?)+", "\n"), "\u0002", " "), "^\n+|\n+$", "")
    kept = F.regexp_replace(F.array_join(plain, "\n"), r"^\s+|\s+$", "")
    return F.when(hard, paragraphs).otherwise(kept)
