"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in normal form: lower case, runs of other characters than
letters and digits as one space. A test passage of ``m`` characters allows
``k = floor(error_rate * m)`` edits and is split into ``k + 1`` pieces: a
document part within ``k`` edits holds at least one piece unchanged. Exact
piece hits are found by one Aho-Corasick pass over the whole document; the
surroundings of each hit (``k`` characters wider than the passage) are verified
with Myers' bit-parallel edit distance with free ends.

The test passages are normalised by Spark and written as a side table; tasks
stream its blocks of at most ``BLOCK_ROWS`` passages past the documents they
have gathered, so the documents are read once, nothing of the benchmark passes
through the driver, and its size never sets a task's memory. A benchmark of one
block is made an automaton once per worker. A test item longer than ``passage_chars`` is tested by its passages of about
that length, cut between words: each passage found counts as the item.

Edge cases: a null or empty document matches nothing; a null or empty test item
(nothing left in normal form) is never matched; an item shorter than
``1 / error_rate`` characters allows no edit and is found wherever its normal
form stands, inside words too, so an item of one letter is in every text with
that letter; equal items are reported each;
repeated document rows give repeated results; an empty table on either side
gives an empty result; a null doc_id is kept; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import frugal, text_slices, texts
from weft.operators.side import prepared_blocks, write_side
from weft.session import cut_lineage, ship_package

ERROR_RATE = 0.05
PASSAGE_CHARS = 1000
#: Passages of one block, and characters of documents that a task holds beside it.
BLOCK_ROWS, GATHER_CHARS = 4096, 16_000_000

_WORDS = re.compile(r"[^\W_]+")


def normal_form(text: str) -> str:
    return " ".join(_WORDS.findall(text.lower()))


def passages(text: str, limit: int = PASSAGE_CHARS) -> list[str]:
    """Normalised text in parts of about ``limit`` characters cut at spaces, as
    equal as that allows."""
    n = -(-len(text) // limit)
    cuts = [0]
    for i in range(1, n):
        at = text.find(" ", max(cuts[-1] + 1, len(text) * i // n))
        if at > 0 and at < len(text) - 1:
            cuts.append(at + 1)
    return [p for p in (text[a:b].strip() for a, b in zip(cuts, [*cuts[1:], len(text)])) if p]


def pieces(passage: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length with their places."""
    bounds = [len(passage) * i // (k + 1) for i in range(k + 2)]
    return [(a, passage[a:b]) for a, b in zip(bounds, bounds[1:])]


def myers(pattern: str, text: str, most: int) -> int | None:
    """Least edit distance of ``pattern`` to any part of ``text``; None if more
    than ``most``. One step of word-parallel additions per character."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        # free start: the row above the pattern stays at zero
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        if score < best:
            best = score
            if not best:
                break
    return best if best <= most else None


class Matcher:
    """Piece automaton of some test passages (item_id, normalised passage)."""

    def __init__(self, tests: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.tests = [(item, text, int(error_rate * len(text))) for item, text in tests]
        of: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, k) in enumerate(self.tests):
            for at, piece in pieces(text, k):
                of.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in of.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Item -> least distance, for the items within their budget of errors."""
        regions: dict[int, list[list[int]]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for n, at in places:
                _, passage, k = self.tests[n]
                lo = end + 1 - length - at - k
                hi = lo + len(passage) + 2 * k
                spans = regions.setdefault(n, [])
                if spans and lo <= spans[-1][1] and hi >= spans[-1][0]:
                    spans[-1] = [min(lo, spans[-1][0]), max(hi, spans[-1][1])]
                else:
                    spans.append([lo, hi])
        found: dict[int, int] = {}
        for n, spans in regions.items():
            item, passage, k = self.tests[n]
            for lo, hi in spans:
                distance = myers(passage, text[max(0, lo) : hi], k)
                if distance is not None and distance < found.get(item, distance + 1):
                    found[item] = distance
                if distance == 0:
                    break
        return found


def written_passages(benchmark: DataFrame) -> str:
    """Folder of the side table (item_id, passage)."""

    def cut(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                rows = [(item, p) for item, text in zip(part.column("item_id").to_pylist(), texts(part.column("text"))) for p in passages(normal_form(text))]
                if rows:
                    items, own = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(own, pa.string())], names=["item_id", "passage"])

    tests = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return write_side(tests.mapInArrow(frugal(cut), "item_id long, passage string"), "passages")


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_rows: int = BLOCK_ROWS, gather_chars: int = GATHER_CHARS) -> DataFrame:
    """(doc_id, item_id, distance): each document that holds a test item within
    its error budget, with the least distance found."""
    ship_package(docs.sparkSession)
    path = written_passages(benchmark)

    def prepare(block: pa.Table) -> Matcher:
        return Matcher(list(zip(block.column("item_id").to_pylist(), block.column("passage").to_pylist())), error_rate)

    def gathered(batches):
        held, size = [], 0
        for batch in batches:
            for part in text_slices(batch, "text", gather_chars):
                held.append(part)
                size += part.column("text").nbytes
                if size >= gather_chars:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def match(batches):
        for held in gathered(batches):
            # rows of the gathered slices, each with its least distance per item:
            # an item cut over two blocks may be found in both
            found: dict[tuple[int, int], dict[int, int]] = {}
            for matcher in prepared_blocks(path, prepare, block_rows):
                for s, part in enumerate(held):
                    for r, text in enumerate(texts(part.column("text"))):
                        for item, distance in matcher.find(normal_form(text)).items():
                            own = found.setdefault((s, r), {})
                            own[item] = min(distance, own.get(item, distance))
            rows = [(held[s].column("doc_id")[r].as_py(), item, d) for (s, r), own in sorted(found.items()) for item, d in sorted(own.items())]
            if rows:
                d, i, e = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(np.array(e, np.int32))], names=["doc_id", "item_id", "distance"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(frugal(match), "doc_id long, item_id long, distance int")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without the documents that hold a test item (rows with a null
    doc_id stay)."""
    hits = cut_lineage(contaminated(docs, benchmark, error_rate).select("doc_id").distinct(), "contaminated")
    return docs.join(hits, "doc_id", "left_anti").select(*docs.columns)
