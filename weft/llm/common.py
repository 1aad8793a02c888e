"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators.side import open_folder  # noqa: F401

#: Text units of one Arrow slice worked on at a time inside a task.
SLICE_CHARS = 4_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_sample(df: DataFrame, keys: list[str], limit: int, n: int | None = None) -> DataFrame:
    """``limit`` rows of ``df`` (all, if fewer): those with the smallest hash of
    ``keys``, which should tell rows apart. ``n`` is the number of rows if known.
    A threshold lets about twice the wanted rows leave the tasks, however many
    tasks there are."""
    n = df.count() if n is None else n
    at = F.pmod(F.xxhash64(*keys), F.lit(1 << 40))
    if n > 2 * limit:
        df = df.where(at < int((1 << 40) * (2 * limit + 50) / n))
    return df.orderBy(at, *keys).limit(limit)


def texts(column) -> Iterator[str]:
    """The values of a string column one by one (never a second whole copy of
    the batch); null counts as empty."""
    for value in column:
        yield value.as_py() or ""


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` whose ``column`` holds about ``limit`` bytes
    each, at least one row: bounds a task's scratch whatever the text lengths."""
    n = batch.num_rows
    lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    total, lo = np.cumsum(lengths), 0
    while lo < n:
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def frugal(task):
    """``task`` for ``mapInArrow`` that gives Arrow's freed memory back when it
    ends: Python workers live on, next to others on their executor."""

    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()

    return run
