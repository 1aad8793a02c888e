"""Sequence packing by cutting-stock column generation.

1. Every text is encoded whole; a document longer than a sequence is cut into
   full sequences and a remainder, other documents stay in one piece.
2. Piece lengths are counted per length class: exact up to ``SHORT``, rounded up
   to multiples of 4, 8 and 16 beyond, so that rounding costs some two parts in a
   hundred at most. At most some hundred counts reach the driver.
3. A linear program over patterns (how many pieces of each class share a
   sequence) is solved by column generation: the dual prices of the classes go
   into an unbounded knapsack, solved by dynamic programming over the capacity;
   its best pattern enters the basis until no pattern improves by ``tolerance``.
4. Pattern counts are rounded down; what is left over (less than one sequence
   per pattern, so bounded by the number of classes) is packed first-fit by
   decreasing size.
   Short pieces are first cut out of bundles of ``BUNDLE`` in the same way; a
   bundle is then one piece of that length.
5. Pieces are ranked within their class by (document, start) and rank ``r``
   takes the ``r``-th slot of its class in the list of patterns. A large class
   is ranked in several hashed groups whose sizes give each group's first rank,
   so no group of pieces grows with the input.
6. Offsets are the running sum of lengths in a sequence (at most ``capacity``
   pieces).

Edge cases: a null text is empty and gives one piece holding the end id; with
``end_id=None`` empty texts give no piece; repeated rows are packed one by one;
ties in the ranking are broken by the ids' checksum; an empty table gives an
empty result; a null doc_id is ranked first; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import frugal, texts
from weft.llm.encoding import END_ID, broadcast_tokenizer, encoder
from weft.session import broadcast_if_small, cut_lineage, ship_package

CAPACITY = 4096
#: Pieces up to SHORT are packed by exact length, into bundles of BUNDLE.
SHORT, BUNDLE = 64, 256
#: Lengths of longer pieces are counted in this unit; (most length, multiple it is rounded up to).
UNIT, ROUNDED = 4, ((256, 4), (512, 8), (CAPACITY, 16))
#: Relative gap to the linear program's bound at which column generation ends.
TOLERANCE = 3e-3
#: Pieces ranked in one group.
GROUP_ROWS = 20_000


# ---------------------------------------------------------------------------
# the cutting-stock program (on the driver, over some hundred classes)
# ---------------------------------------------------------------------------


def _best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern of at most ``capacity``;
    ``sizes`` ascend."""
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fitting[room]:
            gain = best[room - sizes[:n]] + prices[:n]
            k = int(gain.argmax())
            if gain[k] > best[room]:
                best[room], pick[room] = gain[k], k
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            counts[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return float(best[capacity]), counts


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivoting, in plain array operations: the driver's
    cores are Spark's, and threaded linear algebra would fight it for them."""
    m = len(matrix)
    work = np.hstack([matrix, np.eye(m)])
    for j in range(m):
        pivot = j + int(np.abs(work[j:, j]).argmax())
        work[[j, pivot]] = work[[pivot, j]]
        work[j] /= work[j, j]
        factor = work[:, j].copy()
        factor[j] = 0
        work -= factor[:, None] * work[j][None, :]
    return work[:, m:]


def generate_columns(sizes: np.ndarray, demand: np.ndarray, capacity: int, tolerance: float = TOLERANCE, max_rounds: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per row) and how often each is used by the linear program
    ``min sum x, patterns' x = demand``."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))  # column j: pattern of basis position j
    inverse = np.diag(1.0 / np.diag(basis))
    # plain loops: matrices this small only lose by the library's threads
    times = lambda matrix, vector: np.einsum("ij,j->i", matrix, vector)
    x = times(inverse, demand)
    for step in range(max_rounds):
        prices = inverse.sum(axis=0)
        value, column = _best_pattern(np.maximum(prices, 0), sizes, capacity)
        if value <= 1 + tolerance:  # Farley's bound: the program is within that factor of its optimum
            break
        direction = times(inverse, column)
        ok = direction > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, x / np.where(ok, direction, 1), np.inf)
        leave = int(ratio.argmin())
        basis[:, leave] = column
        if step % 256 == 255:
            inverse = _inverse(basis)
        else:
            row = inverse[leave] / direction[leave]
            inverse -= np.outer(direction, row)
            inverse[leave] = row
        x = np.maximum(times(inverse, demand), 0)
    return basis.T[:m], x


def plan_patterns(counts: dict[int, int], capacity: int, tolerance: float = TOLERANCE) -> list[tuple[dict[int, int], int]]:
    """(pattern, times) pairs that hold exactly ``counts`` pieces of each size."""
    sizes = np.array(sorted(counts), dtype=np.int64)
    if not len(sizes):
        return []
    left = np.array([counts[int(s)] for s in sizes], dtype=np.int64)
    patterns, used = generate_columns(sizes, left.astype(float), capacity, tolerance)
    plan = []
    for j in np.argsort(-used, kind="stable"):
        pattern = np.rint(patterns[j]).astype(np.int64)
        times = int(min([int(np.floor(used[j] + 1e-6)), *(left[pattern > 0] // pattern[pattern > 0])]))
        if times > 0:
            left -= times * pattern
            plan.append(({int(s): int(n) for s, n in zip(sizes, pattern) if n}, times))
    # the rest: first fit by decreasing size, by whole patterns while they repeat
    while left.any():
        room, pattern = capacity, np.zeros(len(sizes), np.int64)
        for i in range(len(sizes) - 1, -1, -1):
            pattern[i] = min(int(left[i]), room // int(sizes[i]))
            room -= int(pattern[i] * sizes[i])
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        left -= times * pattern
        plan.append(({int(s): int(n) for s, n in zip(sizes, pattern) if n}, times))
    return plan


def slots(plan: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per size: first rank, first sequence and pieces per sequence of each
    pattern that holds it."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    seen: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        for size, n in pattern.items():
            out.setdefault(size, []).append((seen.get(size, 0), sequence, n))
            seen[size] = seen.get(size, 0) + n * times
        sequence += times
    return {size: tuple(np.array(c, np.int64) for c in zip(*rows)) for size, rows in out.items()}


# ---------------------------------------------------------------------------
# operators
# ---------------------------------------------------------------------------

PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each whole text (``ids``: little-endian
    uint32), with the crc32 of those ids."""
    ship_package(docs.sparkSession)
    spec = broadcast_tokenizer(docs.sparkSession, tokenizer)
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def cut(batches):
        enc = encoder(spec.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, rows = batch.slice(lo, 256), []
                for doc, text in zip(part.column("doc_id").to_pylist(), texts(part.column("text"))):
                    ids = enc.ids(text) + tail
                    for at in range(0, len(ids), 4 * capacity):
                        piece = ids[at : at + 4 * capacity]
                        rows.append((doc, at // 4, len(piece) // 4, len(ids) // 4, zlib.crc32(piece), piece))
                columns = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(frugal(cut), PIECE_SCHEMA)


def _class_of(length: Column, capacity: int) -> Column:
    """Class of a piece: minus its length if it is short, else its rounded length in units."""
    rounded = F.when(length <= min(SHORT, capacity), -length)
    for most, step in ROUNDED:
        rounded = rounded.when(length <= most, F.ceil(length / step) * (step // UNIT))
    rounded = rounded.otherwise(F.ceil(length / ROUNDED[-1][1]) * (ROUNDED[-1][1] // UNIT))
    return F.when(rounded > 0, F.least(rounded, F.lit(capacity // UNIT))).otherwise(rounded).cast("int")


def _plan(counts: dict[int, int], capacity: int):
    """Slots of each class, and those of bundles: short classes take slots of
    bundles, bundles and longer classes those of sequences."""
    short = {-c: n for c, n in counts.items() if c < 0}
    size = min(BUNDLE, capacity)
    bundled = plan_patterns(short, size)
    bundles = sum(times for _, times in bundled)
    longer = {c: n for c, n in counts.items() if c > 0}
    if bundles:
        longer[size // UNIT] = longer.get(size // UNIT, 0) + bundles
    table = slots(plan_patterns(longer, capacity // UNIT))
    return {-c: s for c, s in slots(bundled).items()}, table, size // UNIT, bundles


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (doc_id, start, length <= capacity, ids_crc32, ...) with
    sequence_id and offset. ``pieces`` is read several times: pass a written table."""
    spark = pieces.sparkSession
    sized = pieces.withColumn("_class", _class_of(F.col("length"), capacity))
    counts = {int(r["_class"]): int(r["n"]) for r in sized.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    in_bundles, table, bundle, bundles = _plan(counts, capacity)
    groups = {c: -(-n // group_rows) for c, n in counts.items()}
    many = {c: g for c, g in groups.items() if g > 1}
    number = F.lit(0)
    if many:
        per_class = F.create_map(*[F.lit(v) for pair in many.items() for v in pair])
        number = F.pmod(F.xxhash64("doc_id", "start"), F.coalesce(per_class[F.col("_class")], F.lit(1))).cast("int")
    grouped = sized.withColumn("_group", number)
    order = Window.partitionBy("_class", "_group").orderBy(F.asc_nulls_first("doc_id"), "start", "ids_crc32")
    ranked = grouped.withColumn("_rank", F.row_number().over(order) - 1)
    # pieces of a bundle's length come after the bundles of their class
    first: list[tuple[int, int, int]] = [(bundle, 0, bundles)] if bundles and bundle in counts and bundle not in many else []
    seen: dict[int, int] = {bundle: bundles}
    if many:  # about rows / group_rows counts
        for r in grouped.where(F.col("_class").isin(list(many))).groupBy("_class", "_group").count().orderBy("_class", "_group").collect():
            first.append((r["_class"], r["_group"], seen.get(r["_class"], 0)))
            seen[r["_class"]] = seen.get(r["_class"], 0) + r["count"]
    if first:
        bases = spark.createDataFrame(first, "_class int, _group int, _base long")
        ranked = ranked.join(broadcast_if_small(bases, 1_000_000), ["_class", "_group"], "left").withColumn("_rank", F.col("_rank") + F.coalesce("_base", F.lit(0)))
    # one row per class: its patterns' first ranks, first containers and pieces per
    # container; for the bundled classes those of the bundles behind them
    lists = lambda columns: tuple(a.tolist() for a in columns)
    rows = [(c, *lists(table[c]), None, None, None) for c in counts if c > 0] + [(c, *lists(s), *lists(table[bundle])) for c, s in in_bundles.items()]
    of_class = spark.createDataFrame(rows, "_class int, _ranks array<long>, _in array<long>, _per array<long>, _ranks2 array<long>, _in2 array<long>, _per2 array<long>")

    def container(rank: Column, ranks: str, inside: str, per: str) -> Column:
        k = F.size(F.filter(ranks, lambda x: x <= rank))
        return (F.element_at(inside, k) + F.floor((rank - F.element_at(ranks, k)) / F.element_at(per, k))).cast("long")

    placed = ranked.join(F.broadcast(of_class), "_class").withColumn("_at", container(F.col("_rank"), "_ranks", "_in", "_per"))
    placed = placed.select(*pieces.columns, F.when(F.col("_class") > 0, F.col("_at")).otherwise(container(F.col("_at"), "_ranks2", "_in2", "_per2")).alias("sequence_id"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), F.asc_nulls_first("doc_id"), "start", "ids_crc32")
    return placed.withColumn("offset", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = True, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Packed pieces of whole texts. ``with_ids=False`` leaves the ids
    themselves out of what is shuffled; their checksum stays."""
    if capacity % UNIT:
        raise ValueError(f"the capacity must be a multiple of {UNIT}")
    pieces = cut_pieces(docs, tokenizer, capacity=capacity)
    pieces = cut_lineage(pieces if with_ids else pieces.drop("ids"), "pieces")
    return pack(pieces, capacity, group_rows)
