"""Generators: G1 overlapping fixed-width chunks, G2 ordered steps.

Both are narrow (``explode`` of a per-row array): no shuffle, and a row's
fan-out is bounded by its own text length, so a hot key cannot pile up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions.text import let as _let
from weft.functions.text import nonblank_lines, normalize_ws


def _check_window(size: int, overlap: int) -> None:
    if size <= 0:
        raise ValueError(f"chunk size must be positive, got {size}")
    if overlap < 0:
        raise ValueError(f"chunk overlap must be >= 0, got {overlap}")
    if overlap >= size:
        # The loop form never advances here; refuse instead of spinning.
        raise ValueError(f"chunk overlap ({overlap}) must be smaller than chunk size ({size})")


def chunk(
    df: DataFrame,
    text_col: str = "text",
    id_cols: Sequence[str] = ("doc_id",),
    size: int = 2000,
    overlap: int = 100,
) -> DataFrame:
    """G1 in closed form over the C1-normalised text ``t`` of length ``L``:
    ``L <= size`` gives one chunk ``[0, L)``; otherwise chunk ``k`` of
    ``n = ceil((L - size) / step) + 1`` is ``[k*step, min(k*step + size, L))``
    with ``step = size - overlap``. Lengths count code points.

    Output: id_cols..., chunk_id int, text, chunk_size int, start_char int, end_char int.
    A short (or empty) text still yields one row with offsets ``0`` and ``L``.
    """
    _check_window(size, overlap)
    step = size - overlap
    # The text is cut once into pieces of ``step`` characters; a chunk joins the
    # few pieces its window covers. The chunks leave the row without the text,
    # so the cost is linear in the text whatever its length.
    span = -(-size // step)

    def windows(t: Column) -> Column:
        return _let(F.struct(F.length(t).alias("n"), F.regexp_extract_all(t, F.lit(f"(?s).{{1,{step}}}"), F.lit(0)).alias("p")), rows)

    def rows(c: Column) -> Column:
        return _let(c["n"], lambda n: _let(c["p"], lambda p: F.transform(F.sequence(F.lit(0), _count(n) - 1), lambda k: row(n, p, k))))

    def _count(n: Column) -> Column:
        return F.when(n <= size, F.lit(1)).otherwise(F.floor((n - F.lit(size) + F.lit(step - 1)) / F.lit(step)).cast("int") + 1)

    def row(n: Column, p: Column, k: Column) -> Column:
        start = k * F.lit(step)
        end = F.least(start + F.lit(size), n)
        text = F.substring(F.array_join(F.slice(p, k + 1, F.lit(span)), ""), 1, size)
        return F.struct(k.cast("int").alias("chunk_id"), text.alias("text"), (end - start).cast("int").alias("chunk_size"),
                        start.cast("int").alias("start_char"), end.cast("int").alias("end_char"))

    return df.select(*id_cols, F.inline(_let(normalize_ws(F.col(text_col)), windows)))


def chunk_text(text: Column, chunk_id: Column, size: int, overlap: int) -> Column:
    """The text of chunk ``chunk_id`` of ``text`` (same windows as ``chunk``),
    without generating the other chunks: ``[k*step, min(k*step + size, L))``
    of the C1-normalised text."""
    _check_window(size, overlap)
    t = normalize_ws(text)
    start = chunk_id * F.lit(size - overlap)
    return F.substring(t, start + 1, F.least(start + F.lit(size), F.length(t)) - start)


def extract_steps(
    df: DataFrame, text_col: str = "text", id_cols: Sequence[str] = ("id",)
) -> DataFrame:
    """G2 (+C2, C3, F1): split a response on LF, strip each line, drop blank
    lines and number the rest 1-based in order. Numbering text inside a line
    (``1. Crack eggs``) is kept as part of the step."""
    return df.select(
        *id_cols, F.posexplode(nonblank_lines(F.col(text_col))).alias("_pos", "step")
    ).select(*id_cols, (F.col("_pos") + 1).cast("int").alias("step_idx"), "step")
