"""Benchmark passages against brute force: every window of every text with every window of every item."""

import os
import random
import re

import pytest

from larkspool.llm import decontaminate as D
from tests.llm.test_models import table

SF = "/root/testdata/sf0.01"
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def low(word: bytes) -> bytes:
    out = bytearray(word.lower())  # ASCII only, then the capitals of Latin-1 in UTF-8
    for i in range(len(out) - 1):
        if out[i] == 0xC3 and 0x80 <= out[i + 1] <= 0x9E and out[i + 1] != 0x97:
            out[i + 1] += 0x20
    return bytes(out)


def tokens(text):
    """(words, template tokens as (kind, value))."""
    data = (text or "").encode()
    found = [(m.start(), m.end(), m[0]) for m in WORD.finditer(data)]
    words, out, last = [], [], None
    for start, end, word in found:
        lowered = low(word)
        changed = sum(a != b for a, b in zip(word, lowered))
        lead = word[:1] != lowered[:1] or (word[:1] == b"\xc3" and word[1:2] != lowered[1:2])
        gap = data[last[1] : start] if last else b""
        inside = last is not None and not any(c in b".!?:;\n\r|" for c in gap)
        kind = "number" if word.isdigit() else "unit" if lowered.decode(errors="replace") in D.UNITS else "name" if inside and lead and changed == 1 and len(word) > 1 else ""
        if last and kind == last[2] and kind and len(gap) == 1 and gap in {"number": (b",", b".", b":", b"/"), "name": (b" ", b"-")}.get(kind, ()):
            out[-1] = (kind, out[-1][1] + b" " + lowered)
        else:
            out.append((kind, lowered))
        words.append(lowered)
        last = (start, end, kind)
    return words, out


def windows(text):
    """exact -> [(place, form, values)] for every size."""
    words, template = tokens(text)

    def of(size, exact):
        if exact:
            return [(i, tuple(words[i : i + size]), ()) for i in range(len(words) - size + 1)]
        rows = [(i, template[i : i + size]) for i in range(len(template) - size + 1)]
        return [(i, tuple(k or v for k, v in t), tuple(v for k, v in t if k)) for i, t in rows if 2 * sum(not k for k, _ in t) >= size]

    return len(words), len(template), of


def brute(docs, items):
    out = {}
    for item, text in items:
        n_words, n_tokens, of = windows(text)
        mine = {True: of(min(8, n_words), True) if n_words else [], False: of(min(8, n_tokens), False) if n_tokens >= 5 else []}
        for doc, other in docs:
            _, _, there = windows(other)
            for exact in (True, False):
                places = {}
                size = min(8, n_words if exact else n_tokens)
                if not mine[exact]:
                    continue
                by_form = {}
                for i, form, values in mine[exact]:
                    by_form.setdefault(form, []).append((i, values))
                for place, form, values in there(size, exact):
                    for i, own in by_form.get(form, ()):
                        places.setdefault(place - i, []).append((i, own, values))
                hit = set()
                for copy in places.values():
                    stands = {}
                    if all(stands.setdefault(a, b) == b for _, own, values in copy for a, b in zip(own, values)):
                        hit |= {i for i, _, _ in copy}
                if len(hit) >= min(3, len({i for i, _, _ in mine[exact]})):
                    out.setdefault(doc, set()).add(item)
    return out


def exchanged(r, text):
    """The text with its figures, names and units exchanged, each for one other throughout."""
    words = text.split(" ")
    put = {}
    for i, w in enumerate(words):
        core = re.fullmatch(r"(\W*)(.*?)(\W*)", w, re.S)
        x = core[2]
        if x.isdigit():
            new = put.setdefault(x, r.choice((str(r.randrange(9999)), f"{r.randrange(1, 99)},{r.randrange(100, 999)}")))
        elif i and x.isalpha() and x[:1].isupper() and x[1:].islower() and not re.search(r"[.!?:;\n|]", words[i - 1] + core[1]):
            new = put.setdefault(x, r.choice(("Quillon", "Marbeth", "Tor Vasken", "Elsbeth")))
        elif x in D.UNITS:
            new = put.setdefault(x, r.choice(D.UNITS))
        else:
            continue
        words[i] = core[1] + new + core[3]
    return " ".join(words)


OWN = [
    "A train leaves Boston at 5 pm and travels 60 miles per hour for 3 hours until Boston is far away",
    "Anna has 1,250 apples in New York and gives 75 of them to her friend Bob who eats 4 each day",
    "What is the capital?", "Compute 12 3 45 6 78 9 10 11 of 5 and 7", "the lake holds 40 litres more than the well at Arden holds on 3 days",
    "was paid 40 dollars for less than others and got 40 dollars more than he had before we paid 40 too", "", "one", None,
]


def test_exchanged_items_against_brute_force(spark):
    r = random.Random(4)
    texts = list(OWN)
    if os.path.isdir(SF):
        texts += [x["text"] for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = list(enumerate(texts))
    docs = [(1000 + i, t) for i, t in items]
    for i, t in items:
        if t:
            docs.append((2000 + i, f"before that, {exchanged(r, t)} and more"))
            docs.append((3000 + i, f"Well. {exchanged(r, t)}. {exchanged(r, t)}"))
            w = exchanged(r, t).split(" ")
            docs.append((4000 + i, " ".join(x if not x.isdigit() else str(r.randrange(50)) for x in w)))  # figures that don't stand for one another
            docs.append((5000 + i, " ".join(w[: len(w) // 2])))
    docs += [(1, None), (2, ""), (3, "?!"), (4, "was paid 55 dollars for less than others and got 99 dollars more than he had before we paid 55 too"), (5, "x " * 30000)]
    known = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, hash int, slots string")
    got = {x["doc_id"]: set(x["item_ids"]) for x in D.contaminated(table(spark, docs), known).collect()}
    want = brute(docs, items)
    assert got == want
    found = [i for i, t in items if t and len(t.split()) > 12 and i in got.get(2000 + i, ())]
    assert len(found) >= 0.9 * sum(1 for _, t in items if t and len(t.split()) > 12)
    assert 4 not in got  # 40 stands for 55 and for 99


@pytest.mark.parametrize("bound", ["SENT_HASHES", "SENT_ROWS"])
def test_large_benchmarks_give_the_same(spark, monkeypatch, bound):
    docs = [(i, f"so {t} too") for i, t in enumerate(OWN)]
    items = spark.createDataFrame([(i % 7, t) for i, t in enumerate(OWN * 2)], "item_id long, text string")
    want = sorted((x["doc_id"], *x["item_ids"]) for x in D.contaminated(table(spark, docs), items).collect())
    monkeypatch.setattr(D, bound, 0)
    assert want and want == sorted((x["doc_id"], *x["item_ids"]) for x in D.contaminated(table(spark, docs), items).collect())
