"""Edge rows of the splitter and of the assembled text."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspool.functions import text as T
from larkspool.operators.split import split_parts


def parts(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    out = {}
    for r in split_parts(rows, ["id"], "t").orderBy("id", "part_no").collect():
        out.setdefault(r["id"], []).append(r)
    return out


def test_hard_cut_of_an_unpunctuated_run(spark):
    got = parts(spark, "x" * 3000)[0]
    assert [r["total_parts"] for r in got] == [3, 3, 3]
    # the overlap has no blank to snap to, so the whole tail is repeated
    assert [r["part_char_count"] for r in got] == [1200, 200 + 1 + 1200, 200 + 1 + 600]


def test_blank_lines_go_and_tabs_stay(spark):
    assert parts(spark, "a\n\n\t\nb")[0][0]["part_text"] == "a\n\t\nb"


def test_protected_and_unprotected_abbreviations_are_rejoined(spark):
    text = "See U.S. Customs. Docket No. 5 applies (here). Then more."
    assert [r["part_text"] for r in parts(spark, text)[0]] == [text]


def test_overlap_starts_at_a_word(spark):
    words = " ".join(f"word{i}." for i in range(400))
    got = [r["part_text"] for r in parts(spark, words)[0]]
    assert len(got) > 1
    for before, after in zip(got, got[1:]):
        head, _, body = after.partition("\n")
        assert before.endswith(head) and head.startswith("word") and len(head) < 200
        assert body


def test_null_blank_and_empty_texts_have_no_parts(spark):
    assert parts(spark, None, "", "   ", "\n\n") == {}


def test_code_points_are_counted(spark):
    got = parts(spark, "😀" * 1300)[0]
    assert [r["part_char_count"] for r in got] == [1200, 301]


def brute(text, target=1200, overlap=200):
    """The same split, step by step, for comparison."""
    import re

    pieces = []
    for i, line in enumerate(text.split("\n")):
        if not line.strip(" "):
            continue
        for j, sentence in enumerate(re.split(r"(?<=[a-z0-9)\]][.?!])[ \t\n\x0b\f\r]+", line)):
            if sentence.strip(" "):
                for k in range(0, len(sentence), target):
                    pieces.append(("\n" if i and not j and not k else " ") + sentence[k : k + target])
    out, now = [], ""
    for p in pieces:
        if not now:
            now = p[1:]
        elif len(now) + len(p) <= target:
            now += p
        else:
            out.append(now)
            now = p[1:]
    out += [now] if now else []
    full = out[:1]
    for before, part in zip(out, out[1:]):
        tail = before[-overlap:]
        full.append((tail.split(" ", 1)[1] if " " in tail else tail) + "\n" + part)
    return full


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .?)\n\tZé", max_size=4000), min_size=1, max_size=4))
def test_against_brute_force(spark, texts):
    got = parts(spark, *texts)
    assert [[r["part_text"] for r in got.get(i, [])] for i in range(len(texts))] == [brute(t) for t in texts]


@pytest.mark.parametrize("body,over", [(2000 - 22, False), (2001 - 22, True)])
def test_ceiling_is_measured_on_the_assembled_text(spark, body, over):
    row = spark.range(1).select(F.lit("Title").alias("t"), F.lit("Agency").alias("a"), F.lit("Head").alias("h"), F.repeat(F.lit("x"), body).alias("b"))
    cols = [F.col(c) for c in "tahb"]
    n, is_over = row.select(F.length(T.chunk_text(*cols)), T.is_oversized(*cols)).first()
    assert n == body + 22 and is_over is over


def test_null_pieces(spark):
    row = spark.range(1).select(F.lit(None).cast("string").alias("n"), F.lit("T").alias("t"), F.lit("B").alias("b"))
    n, t, b = F.col("n"), F.col("t"), F.col("b")
    got = row.select(T.chunk_text(t, n, n, b), T.chunk_text(n, t, t, b), T.chunk_text(t, t, t, n)).first()
    assert list(got) == ["T (Unknown agency)\n\nB", "T\n\nB", "T (T)\n\nT"]
