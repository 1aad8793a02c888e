"""Substring dedup over word windows with a count-min prefilter.

A window is ``window`` consecutive words of one document. A word is removed if
a window covering it also starts earlier (smaller doc_id, or the same document
at an earlier word); windows are judged on the input.

1. A window is counted by its anchor: of its runs of ``GRAM`` words the one with
   the smallest hash, the leftmost of equals. Equal windows have equal anchors at
   equal offsets, so a window occurring twice has an anchor occurring twice at
   least, and neighbouring windows share anchors: there is one for about seven
   words. Partitions sketch the counts of their anchors: two rows of cells, each
   a counter that stops at two, written as sparse lists (cells seen once, cells
   seen twice) per chunk of the sketch. The lists are merged chunk by chunk into
   bitmaps of the cells counted twice, a side table. Cells are sized from the
   text's volume (``CELLS`` per anchor) and have no upper bound; estimates only
   ever exceed the true count, so no repeated window is lost.
2. A second scan gathers text, streams the side table's chunks past the gathered
   anchors (a small sketch is kept by the worker), and keeps windows whose anchor
   is estimated repeated in both rows. Inside a gathered piece, all but the first
   occurrence of a window are known to be repeats at once and leave as runs; only
   the first goes to the exact grouping by a 128-bit hash of its words. A window
   that is in every document therefore reaches the grouping once per piece, not
   once per document.
3. In each group all but the first (smallest doc_id, start) are repeats. They
   are merged to runs per document and written; runs of a checked size are
   broadcast to the documents, so that no text moves, larger ones meet them in
   a join on doc_id. Covered words are dropped.

Memory: a task holds sparse lists of at most ``LIST_ANCHORS`` anchors in the first
scan, and the window hashes of ``GATHER_CHARS`` characters and one chunk of the
sketch in the second. The sketch is read once per gathered piece, so the second
scan's reading grows with its size; it stays small beside the hashing of the
text up to some hundred gigabytes of text (README).

Edge cases: a null text has no words; fewer words than a window: nothing is
removed; rows with a null doc_id have no place in the order, so they keep all
words and remove none; rows repeating a doc_id are versions of one document:
equal starts are no earlier ones, and a removal applies to each version;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import frugal, open_folder, text_slices, texts
from weft.operators.side import write_side
from weft.session import broadcast_if_small, cut_lineage, ship_package

WINDOW = 20
#: Words of an anchor.
GRAM = 8
#: Characters per word assumed when the sketch is sized (any value is correct).
CHARS_PER_WORD = 6
#: Cells per anchor expected, and the bits of one chunk of a row of them.
CELLS, CHUNK_BITS = 6, 1 << 21
#: Anchors whose cells a task lists before it passes them on.
LIST_ANCHORS = 500_000
#: Characters of text whose words a task holds at once, and whose windows.
SLICE_CHARS, GATHER_CHARS = 1_000_000, 6_000_000
#: Bytes of a sketch that a worker keeps, instead of reading it again.
KEPT_BYTES = 32 << 20
#: Most bytes of runs that are broadcast.
RUN_BYTES, RUN_ROWS = 64 << 20, 4_000_000

_M1, _M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # fixed odd multipliers


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _rolling(values: np.ndarray, window: int, multiplier: int) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every window of ``values``."""
    powers = np.full(window, multiplier, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    out = np.zeros(len(values) - window + 1, np.uint64)
    for j in range(window):
        out += values[j : j + len(out)] * powers[j]
    return _mix(out)


class Windows:
    """The windows of a slice: two 64-bit hashes, row and start word of each, and
    the number of its anchor among the slice's anchors (two hashes each)."""

    def __init__(self, batch: pa.RecordBatch, window: int):
        words: list[bytes] = []
        counts = []
        for doc, text in zip(batch.column("doc_id"), texts(batch.column("text"))):
            own = text.encode("utf-8", "surrogatepass").split() if doc.is_valid else []
            words += own
            counts.append(len(own))
        gram = min(GRAM, window)
        self.size = 0
        if len(words) < window:
            return
        a = word_hashes(words)
        del words
        sizes = np.asarray(counts, np.int64)
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        start = (np.arange(len(a)) - (np.cumsum(sizes) - sizes)[row]).astype(np.int32)
        whole = np.nonzero((start + window <= sizes[row])[: len(a) - window + 1])[0]
        b = _mix(a + np.uint64(_M2))
        g1, g2 = _rolling(a, gram, _M1), _rolling(b, gram, _M2)
        # the leftmost smallest of the grams of each window
        n = len(a) - window + 1
        least, at = g1[:n].copy(), np.arange(n)
        for j in range(1, window - gram + 1):
            new = g1[j : j + n] < least
            least[new], at[new] = g1[j : j + n][new], np.nonzero(new)[0] + j
        place, self.anchor = np.unique(at[whole], return_inverse=True)
        self.g1, self.g2 = g1[place], g2[place]
        self.h1, self.h2 = _rolling(a, window, _M1)[whole], _rolling(b, window, _M2)[whole]
        self.row, self.start, self.size = row[whole], start[whole], len(whole)


# ---------------------------------------------------------------------------
# the sketch
# ---------------------------------------------------------------------------


def sketch_cells(chars: int, window: int = WINDOW, per_anchor: int = CELLS) -> int:
    """Whole chunks of cells for the anchors expected: two of each
    ``window - GRAM + 2`` runs of words are smallest somewhere."""
    anchors = 2 * chars // CHARS_PER_WORD // (window - min(GRAM, window) + 2)
    return CHUNK_BITS * max(1, -(-per_anchor * anchors // CHUNK_BITS))


def cell_lists(hashes: list[np.ndarray], r: int, cells: int):
    """Sparse partition sketch of row ``r``: per chunk the cells seen, and those
    seen more than once, as offsets in the chunk."""
    cell = np.sort(np.concatenate(hashes) % np.uint64(cells)).astype(np.int64)
    if not len(cell):
        return
    first = np.nonzero(np.concatenate(([True], cell[1:] != cell[:-1])))[0]
    own, more = cell[first], np.diff(np.append(first, len(cell))) > 1
    chunk = own // CHUNK_BITS
    cuts = [0, *(np.nonzero(np.diff(chunk))[0] + 1).tolist(), len(own)]
    offset = (own % CHUNK_BITS).astype("<u4")
    parts = [(int(chunk[lo]), zlib.compress(offset[lo:hi].tobytes(), 1), zlib.compress(offset[lo:hi][more[lo:hi]].tobytes(), 1)) for lo, hi in zip(cuts, cuts[1:])]
    k, once, twice = zip(*parts)
    yield pa.RecordBatch.from_arrays([pa.array([r] * len(k), pa.int32()), pa.array(k, pa.int64()), pa.array(once), pa.array(twice)], names=["r", "k", "once", "twice"])


class Chunk:
    """Counters stopping at two for one chunk of a row."""

    def __init__(self):
        self.once, self.twice = np.zeros(CHUNK_BITS, bool), np.zeros(CHUNK_BITS, bool)

    def add(self, once: bytes, twice: bytes) -> None:
        own = np.frombuffer(zlib.decompress(once), "<u4")
        self.twice[own[self.once[own]]] = True
        self.twice[np.frombuffer(zlib.decompress(twice), "<u4")] = True
        self.once[own] = True


def build_sketch(docs: DataFrame, window: int, cells: int) -> str:
    """Folder of the merged sketch: (r, k, bits) of each chunk with a cell counted twice."""

    def local(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_CHARS):
                found = Windows(part, window)
                if not found.size:
                    continue
                held.append((found.g1, found.g2))
                n += len(found.g1)
                if n >= LIST_ANCHORS:
                    for r in range(2):
                        yield from cell_lists([h[r] for h in held], r, cells)
                    held, n = [], 0
        for r in range(2) if held else ():
            yield from cell_lists([h[r] for h in held], r, cells)

    def merged(batches):
        at, chunk = None, None

        def result():
            if chunk is not None and chunk.twice.any():
                bits = np.packbits(chunk.twice, bitorder="little").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([bits])], names=["r", "k", "bits"])

        for batch in batches:
            for r, k, once, twice in zip(*(batch.column(c) for c in ("r", "k", "once", "twice"))):
                if (key := (r.as_py(), k.as_py())) != at:
                    yield from result()
                    at, chunk = key, Chunk()
                chunk.add(once.as_py(), twice.as_py())
        yield from result()

    lists = docs.mapInArrow(frugal(local), "r int, k long, once binary, twice binary")
    whole = lists.repartition("r", "k").sortWithinPartitions("r", "k").mapInArrow(frugal(merged), "r int, k long, bits binary")
    return write_side(whole, "sketch")


#: A worker's small sketches, by folder.
_SKETCHES: dict[str, list] = {}


def sketch_chunks(path: str):
    """(r, k, bits) of the merged sketch, chunk by chunk; a small one is read once per worker."""
    import pyarrow.dataset as ds

    if path in _SKETCHES:
        yield from _SKETCHES[path]
        return
    system, folder = open_folder(path)
    source = ds.dataset(folder, filesystem=system, format="parquet", exclude_invalid_files=True)
    kept, size = [], 0
    for batch in source.to_batches(batch_size=8, batch_readahead=1, fragment_readahead=1):
        for r, k, bits in zip(*(batch.column(c) for c in ("r", "k", "bits"))):
            row = (r.as_py(), k.as_py(), np.frombuffer(bits.as_py(), np.uint8))
            size += len(row[2])
            if kept is not None:
                kept = [*kept, row] if size <= KEPT_BYTES else None
            yield row
    if kept is not None:
        _SKETCHES.clear()
        _SKETCHES[path] = kept


def estimated_repeated(path: str, cells: int, anchors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which of the anchors (two hashes each) have both cells counted twice."""
    found = []
    for r in range(2):
        cell = (np.concatenate([a[r] for a in anchors]) % np.uint64(cells)).astype(np.int64)
        order = np.argsort(cell)
        found.append((cell[order], order, np.zeros(len(cell), bool)))
    for r, k, bits in sketch_chunks(path):
        cell, order, hit = found[r]
        lo, hi = np.searchsorted(cell, (k * CHUNK_BITS, (k + 1) * CHUNK_BITS))
        own = cell[lo:hi] - k * CHUNK_BITS
        hit[order[lo:hi]] = (bits[own >> 3] >> (own & 7).astype(np.uint8)) & 1
    return found[0][2] & found[1][2]


# ---------------------------------------------------------------------------
# repeats
# ---------------------------------------------------------------------------


def _runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive starts of a document: doc, first start, length."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    cut = np.nonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1))))[0]
    last = np.append(cut[1:], len(doc)) - 1
    return doc[cut], start[cut], start[last] - start[cut] + 1


def merge_runs(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts joined where they touch: document number, start, length."""
    at = (doc << 40) + start
    order = np.argsort(at, kind="stable")
    at = at[order]
    end = np.maximum.accumulate(at + n[order])
    cut = np.nonzero(np.concatenate(([True], at[1:] > end[:-1])))[0]
    last = np.append(cut[1:], len(at)) - 1
    return at[cut] >> 40, at[cut] & ((1 << 40) - 1), end[last] - at[cut]


def gathered(batches, window: int):
    """Slices of a task's rows with their windows, about ``GATHER_CHARS`` characters at a time."""
    held, size = [], 0
    for batch in batches:
        for part in text_slices(batch, "text", SLICE_CHARS):
            found = Windows(part, window)
            size += part.column("text").nbytes
            if found.size:
                doc = np.asarray(part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), np.int64)
                held.append((found, doc))
            if size >= GATHER_CHARS and held:
                yield held
                held, size = [], 0
    if held:
        yield held


def repeated_runs(docs: DataFrame, window: int = WINDOW, cells: int | None = None) -> DataFrame:
    """(doc_id, starts, ns), written: the runs of ``n`` consecutive window starts
    of a document that also start earlier."""
    ship_package(docs.sparkSession)
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    if cells is None:
        cells = sketch_cells(known.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0, window)
    sketch = build_sketch(known, window, cells)
    found = known.mapInArrow(frugal(candidates(sketch, cells, window)), "h1 long, h2 long, doc_id long, start long, n long")
    # a head has n = 0; the runs known already have keys of their own
    first = Window.partitionBy("h1", "h2").orderBy("doc_id", "start")
    later = found.withColumn("_rank", F.rank().over(first)).where("n > 0 OR _rank > 1").withColumn("n", F.greatest("n", F.lit(1)))

    def merge(batches):
        for batch in batches:
            of = batch.column("runs")
            parts = of.flatten()
            sizes = np.diff(np.asarray(of.offsets))
            doc, start, n = merge_runs(np.repeat(np.arange(len(sizes)), sizes), *(np.asarray(parts.field(c)) for c in ("start", "n")))
            offsets = pa.array(np.searchsorted(doc, np.arange(len(sizes) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (start, n))], names=["doc_id", "starts", "ns"])

    # a document has at most as many runs as words
    per_doc = later.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    runs = cut_lineage(per_doc.mapInArrow(merge, "doc_id long, starts array<long>, ns array<long>"), "runs")
    return runs


def candidates(sketch: str, cells: int, window: int):
    """Task: (h1, h2, doc_id, start, 0) of the first occurrence in a gathered piece of
    each window estimated repeated, and (doc_id, start, doc_id, start, n) of the runs
    of its later ones."""

    def second(batches):
        for held in gathered(batches, window):
            repeated = estimated_repeated(sketch, cells, [(w.g1, w.g2) for w, _ in held])
            columns, at = [], 0
            for w, doc in held:
                keep = repeated[at : at + len(w.g1)][w.anchor]
                at += len(w.g1)
                columns.append((w.h1[keep], w.h2[keep], doc[w.row[keep]], w.start[keep].astype(np.int64)))
            del held
            h1, h2, doc, start = (np.concatenate(c) for c in zip(*columns))
            del columns
            if not len(h1):
                continue
            order = np.lexsort((start, doc, h2, h1))
            h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
            fresh = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            head = np.nonzero(fresh)[0][np.cumsum(fresh) - 1]
            later = (doc != doc[head]) | (start != start[head])
            names = ["h1", "h2", "doc_id", "start", "n"]
            columns = [h1[fresh].view(np.int64), h2[fresh].view(np.int64), doc[fresh], start[fresh], np.zeros(int(fresh.sum()), np.int64)]
            yield from _pieces(columns, names)
            if later.any():
                d, s, m = _runs(doc[later], start[later])
                yield from _pieces([d, s, d, s, m], names)

    return second


def _pieces(columns: list[np.ndarray], names: list[str], rows: int = 65_536):
    for lo in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + rows]) for c in columns], names=names)


def remove_repeats(docs: DataFrame, window: int = WINDOW, cells: int | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text (kept words joined by one
    space) and kept_sha256."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    runs = broadcast_if_small(repeated_runs(plain, window, cells), RUN_ROWS, RUN_BYTES)

    def drop(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_CHARS):
                out = []
                for doc, text, starts, ns in zip(part.column("doc_id").to_pylist(), texts(part.column("text")), part.column("starts"), part.column("ns")):
                    words = text.encode("utf-8", "surrogatepass").split()
                    n, removed = len(words), 0
                    if starts.is_valid:
                        edge = np.zeros(n + 1, np.int64)
                        s = np.minimum(np.asarray(starts.values), n)
                        np.add.at(edge, s, 1)
                        np.add.at(edge, np.minimum(s + np.asarray(ns.values) + window - 1, n), -1)
                        keep = np.cumsum(edge[:-1]) == 0
                        words = list(compress(words, keep.tolist()))
                        removed = n - len(words)
                    kept = b" ".join(words)
                    out.append((doc, n, removed, kept.decode("utf-8", "surrogatepass"), hashlib.sha256(kept).hexdigest()))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])], names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])

    joined = plain.join(runs, "doc_id", "left").select("doc_id", "text", "starts", "ns")
    return joined.mapInArrow(frugal(drop), "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
