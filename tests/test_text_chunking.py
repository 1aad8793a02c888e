"""Text normalisation, chunking and step extraction."""

import csv
import math
import os
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import FIXTURES
from weft.functions.text import is_yes, normalize_ws, tokens, ustrip
from weft.operators.chunking import chunk, extract_steps

# Python's own whitespace set, the behaviour C1/C2 must reproduce.
PY_WS = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def py_normalize(t):
    return re.sub(r"\s+", " ", t).strip()


def py_chunks(text, size, overlap):
    """The loop form of G1 (fixed windows, no natural breaks)."""
    t = py_normalize(text)
    if len(t) <= size:
        return [t]
    out, start = [], 0
    while start < len(t):
        end = min(start + size, len(t))
        out.append(t[start:end])
        if end == len(t):
            break
        start = end - overlap
    return out


def test_whitespace_class_is_pythons(spark):
    assert len(PY_WS) == 29
    text = "a" + "".join(PY_WS) + "b" + PY_WS[5] + "c"
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(normalize_ws("t").alias("n"), ustrip(F.concat(F.lit("   x\r"), F.lit(" y\x1c　"))).alias("s")).first()
    assert got["n"] == py_normalize(text) == "a b c"
    assert got["s"] == "x\r y".strip() and got["s"] == "   x\r y\x1c　".strip()


@pytest.mark.parametrize("text", ["", "   ", "\t\r\n", "x\u0085y", "crlf\r\nline", "nb sp", None])
def test_normalize_edge_rows(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(normalize_ws("t").alias("n")).first()["n"]
    assert got == (None if text is None else py_normalize(text))


def test_golden_chunks(spark, knowledge_text):
    """The reference's recorded chunk file: 13 chunks, size 500, overlap 200."""
    with open(os.path.join(FIXTURES, "golden_chunks.csv"), newline="", encoding="utf-8") as f:
        golden = [(r["text"], int(r["chunk_size"])) for r in csv.DictReader(f)]
    df = spark.createDataFrame([(0, knowledge_text)], "doc_id long, text string")
    got = chunk(df, "text", ["doc_id"], 500, 200).orderBy("chunk_id").select("text", "chunk_size").collect()
    assert [(r["text"], r["chunk_size"]) for r in got] == golden
    assert len(golden) == 13 and golden[-1][1] == 298


def test_chunk_edges(spark):
    s, o = 10, 3
    texts = ["", "a" * 9, "a" * 10, "b" * 11, "c" * 17, "😀" * 12 + "z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = chunk(df, "text", ["doc_id"], s, o).orderBy("doc_id", "chunk_id").collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(texts):
        assert [r["text"] for r in by_doc[i]] == py_chunks(t, s, o)
        assert by_doc[i][0]["start_char"] == 0
        assert by_doc[i][-1]["end_char"] == len(t)
    # short and empty texts still give one row (quirk 2/3 fixed)
    assert len(by_doc[0]) == 1 and by_doc[0][0]["chunk_size"] == 0


@pytest.mark.parametrize("size,overlap", [(0, 0), (5, -1), (5, 5), (5, 9)])
def test_chunk_rejects_bad_windows(spark, size, overlap):
    df = spark.createDataFrame([(0, "abc")], "doc_id long, text string")
    with pytest.raises(ValueError):
        chunk(df, "text", ["doc_id"], size, overlap)


@settings(max_examples=60, deadline=None)
@given(n=st.integers(0, 400), size=st.integers(1, 60), data=st.data())
def test_chunk_closed_form_matches_loop(n, size, data):
    """Property (pure arithmetic, no Spark): the closed form used by ``chunk``
    equals the loop; neighbours overlap by exactly ``o``; stripping the
    overlap restores the text."""
    o = data.draw(st.integers(0, size - 1))
    t = "".join(chr(97 + (i * 7) % 26) for i in range(n))
    step = size - o
    if n <= size:
        wins = [(0, n)]
    else:
        k = math.ceil((n - size) / step) + 1
        wins = [(j * step, min(j * step + size, n)) for j in range(k)]
    pieces = [t[a:b] for a, b in wins]
    assert pieces == py_chunks(t, size, o)
    for (a0, b0), (a1, _) in zip(wins, wins[1:]):
        assert b0 - a1 == o
    assert pieces[0] + "".join(p[o:] for p in pieces[1:]) == t


def test_extract_steps_golden(spark):
    """The recorded planner answer: 8 numbered steps, numbering kept in the text."""
    answer = (
        "1. Crack eggs into a bowl\n2. Beat eggs with a fork until mixed\n\n"
        "3. Heat pan with butter or oil over medium heat\n  4. Pour egg mixture into pan\r\n"
        "5. Stir gently as eggs cook\n6. Remove from heat when eggs are just set but still moist\n"
        "   \n7. Season with salt and pepper\n8. Serve immediately\n"
    )
    df = spark.createDataFrame([(1, answer)], "id long, text string")
    got = extract_steps(df, "text", ["id"]).orderBy("step_idx").collect()
    assert [r["step_idx"] for r in got] == list(range(1, 9))
    assert got[0]["step"] == "1. Crack eggs into a bowl"
    assert got[3]["step"] == "4. Pour egg mixture into pan"
    assert got[7]["step"] == "8. Serve immediately"


def test_tokens_and_verdicts(spark):
    df = spark.createDataFrame(
        [(1, "Yes"), (2, " yes, fine"), (3, "Yesterday"), (4, "**Yes**"), (5, "No"), (6, ""), (7, None), (8, " YES.")],
        "id int, e string")
    got = dict(df.select("id", is_yes("e").alias("ok")).collect())
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: False, 8: True}
    t = spark.createDataFrame([("  Hello\tWORLD  hello ",)], "t string").select(tokens("t").alias("x")).first()["x"]
    assert t == ["hello", "world", "hello"]


def test_tokens_of_normalised_text_skip_c1(spark, knowledge_text):
    """Chunk text is already normalised: the short-cut tokeniser gives the same tokens."""
    df = spark.createDataFrame([(0, knowledge_text + "  Ünïcode TAIL ")], "doc_id long, text string")
    ch = chunk(df, "text", ["doc_id"], 37, 11)
    bad = ch.where(tokens("text") != tokens("text", normalized=True)).count()
    assert ch.count() > 100 and bad == 0


def test_chunk_text_by_window_equals_generated_chunks(spark, knowledge_text):
    from weft.operators.chunking import chunk_text

    df = spark.createDataFrame([(0, knowledge_text), (1, "short"), (2, "")], "doc_id long, text string")
    gen = chunk(df, "text", ["doc_id"], 500, 200)
    cut = gen.select("doc_id", "chunk_id", "text").join(df.withColumnRenamed("text", "raw"), "doc_id").where(
        chunk_text(F.col("raw"), F.col("chunk_id"), 500, 200) != F.col("text"))
    assert gen.count() == 15 and cut.count() == 0


def test_unicode_whitespace_parity_random(spark):
    """Property: C1 and C2 in Spark equal Python's ``re.sub(r'\\s+', ' ', t).strip()``
    and ``str.strip()`` on random text over all whitespace code points and
    near misses (zero-width space, U+180E, BOM are not whitespace)."""
    import random

    rng = random.Random(42)
    alphabet = PY_WS + ["a", "B", "é", "😀", "​", "᠎", "﻿", ".", "-"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r["id"]: (r["n"], r["s"]) for r in df.select("id", normalize_ws("t").alias("n"), ustrip("t").alias("s")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (py_normalize(t), t.strip()), repr(t)
