"""Token counts of sections by offset mapping.

Whole documents are encoded once; the tokens' character spans are joined with
the sections' spans (disjoint and sorted, so the interval join is a search by
bisection inside the row) and every token is given to exactly one section.

A token that crosses a boundary is allocated by ``rule``:

* ``majority`` (default): the section holding most of its characters, ties to
  the earlier one;
* ``start``: the section holding its first character;
* ``end``: the section holding its last character.

The default sections are sentences: a boundary follows every run of ``.!?``
that ends a sentence mark and every line break, so sections cover the text and
their counts add up to the document's. Any other splitter ``text -> ends`` may
be passed.

Edge cases: a null or empty text has one empty section with no tokens; a token
outside every section cannot occur, as sections cover the text; repeated rows
are counted each; an empty table gives an empty result; a null doc_id is kept;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import frugal, texts
from weft.llm.encoding import broadcast_tokenizer, encoder
from weft.session import ship_package

RULES = ("majority", "start", "end")
_END = re.compile("[.!?]|\n")


def sentence_ends(text: str) -> list[int]:
    """Ends of the sections: after each sentence mark or line break, and at the
    text's end."""
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    return ends


def owner(span: tuple[int, int], bounds: np.ndarray, rule: str = "majority") -> tuple[int, bool]:
    """Section a token span is given to, and whether it crosses a boundary.
    ``bounds``: ascending ends of sections that cover the text."""
    start, end = span
    first, last = np.searchsorted(bounds, [start, max(end - 1, start)], side="right").tolist()
    if first == last or rule == "start":
        return first, last > first
    if rule == "end":
        return last, True
    return first + int(np.argmax(np.diff([start, *bounds[first:last].tolist(), end]))), True


def allocate(groups, bounds: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and crossing tokens, given to each section. ``groups``: runs of
    tokens as ``Encoder.groups`` returns them; only runs that meet a boundary
    are looked at token by token."""
    starts, ends, counts, inside = groups
    first = np.searchsorted(bounds, starts, side="right")
    last = np.searchsorted(bounds, np.maximum(ends - 1, starts), side="right")
    whole = first == last
    tokens = np.bincount(first[whole], weights=counts[whole], minlength=len(bounds)).astype(np.int64)
    crossing = np.zeros(len(bounds), np.int64)
    for i in np.nonzero(~whole)[0].tolist():
        for span in inside(i):
            section, crosses = owner(span, bounds, rule)
            tokens[section] += 1
            crossing[section] += crosses
    return tokens, crossing


def section_counts(docs: DataFrame, tokenizer: str | None = None, splitter: Callable[[str], list[int]] = sentence_ends, rule: str = "majority") -> DataFrame:
    """One row per section: doc_id, section (from 0), start_char, end_char,
    n_tokens (allocated to it) and n_crossing (those of them that cross)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship_package(docs.sparkSession)
    spec = broadcast_tokenizer(docs.sparkSession, tokenizer)

    def task(batches):
        enc = encoder(spec.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, columns = batch.slice(lo, 256), []
                for doc, text in zip(part.column("doc_id").to_pylist(), texts(part.column("text"))):
                    bounds = np.asarray(splitter(text), np.int64)
                    columns.append((doc, len(bounds), bounds, *allocate(enc.groups(text), bounds, rule)))
                if not columns:
                    continue
                ids = pa.array([c[0] for c in columns], pa.int64()).take(pa.array(np.repeat(np.arange(len(columns)), [c[1] for c in columns])))
                cat = lambda k: np.concatenate([c[k] for c in columns])
                begins = np.concatenate([np.concatenate(([0], c[2][:-1])) for c in columns])
                number = np.concatenate([np.arange(c[1]) for c in columns])
                yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(begins), pa.array(cat(2)), pa.array(cat(3), pa.int64()), pa.array(cat(4), pa.int64())], names=["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(frugal(task), "doc_id long, section int, start_char long, end_char long, n_tokens long, n_crossing long")
