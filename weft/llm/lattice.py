"""Near-duplicate vectors by E8 lattice hashing.

Vectors of the same label link if their cosine, in double precision, is at least
``threshold``.

1. Equal vectors of a label become one node with a multiplicity.
2. A table projects a unit vector by a random Gaussian matrix to one or more
   times 8 dimensions, divides by a cell width and decodes each part to its
   nearest E8 lattice point. The vector is posted in that cell and in the
   ``PROBES`` neighbouring ones (along the lattice's 240 shortest vectors) that
   its point lies closest to. Number of parts and width follow from the size of
   the largest label, so that a cell holds few strangers at any size; there are
   more tables when there are more parts.
3. Cells with one posting end there. Cells of equal members, whatever their
   table, are kept once. In each remaining cell all members are compared by
   cosine, and the edges of a spanning forest of the links leave the task.
   A crowded cell is dealt as pairs of chunks to many tasks, none is capped.
4. Components of the edges are found by alternating stars. Within each component,
   again in pairs of chunks, all members are compared, which counts the links
   of every vector exactly, those between vectors that shared no cell included.
   No pair leaves a task.

Recall concerns components only: two linked vectors are missed if they share no
cell in any table and no chain of found links joins them. At a cosine of exactly
0.98 a pair shares a cell of one of the tables with a chance of over 0.999
(measured by a test); closer pairs are safer still.

Edge cases: vectors that are null, zero, or hold null or non-finite components,
and rows with a null label or null vec_id link with nothing and form components
of their own (null for a null vec_id, then ``kept`` is false); vectors of
different lengths do not link; every row is a vector of its own, rows repeating
a vec_id or a vector too; no rows give an empty result; extra columns are
ignored. Norms are taken of the vector over its largest component, so tiny and
huge vectors do not under- or overflow.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import frugal
from weft.llm.components import components
from weft.session import broadcast_if_small, cut_lineage, ship_package, spread

THRESHOLD = 0.98
#: Neighbouring cells probed per table, and strangers expected beside a vector per table.
PROBES, STRANGERS = 4, 0.1
#: A cell is at least this wide; narrower ones would part near vectors.
LEAST_WIDTH = 1.4
#: Members of a group that are compared in one piece; larger groups are dealt in chunks.
CHUNK = 1024
#: Vectors hashed at once.
_ROWS = 2048
_SEED = 8

_M = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier


# ---------------------------------------------------------------------------
# the lattice
# ---------------------------------------------------------------------------


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries +-1, or all +-1/2 with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of an even sum: round, and where the
    sum is odd round the coordinate that was closest to a half the other way."""
    r = np.rint(y)
    gap = y - r
    odd = np.nonzero(r.sum(axis=1).astype(np.int64) & 1)[0]
    worst = np.argmax(np.abs(gap[odd]), axis=1)
    r[odd, worst] += np.where(gap[odd, worst] >= 0, 1.0, -1.0)
    return r


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: E8 is D8 and D8 shifted by one half."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1))[:, None], a, b)


_ROOTS = shortest_vectors()


class Hashing:
    """Width and number of parts and tables for ``n`` vectors that may meet."""

    def __init__(self, n: int, probes: int = PROBES):
        self.probes, self.parts = probes, 1
        # two random unit vectors share a cell of width w with a chance of about
        # (w^8 / (4 pi)^4) ^ parts
        while self.width(n) < LEAST_WIDTH:
            self.parts += 1
        self.w = min(self.width(n), 2.0)
        self.tables = max(3, 4 * self.parts - 3)

    def width(self, n: int) -> float:
        chance = STRANGERS / (max(n, 1) * (1 + self.probes) ** 2)
        return float(((4 * np.pi) ** 4 * chance ** (1 / self.parts)) ** 0.125)

    def cells(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Numbers (rows x (1 + probes)) of the cells that each unit vector is posted in."""
        rnd = np.random.default_rng((_SEED, table, unit.shape[1]))
        y = unit @ rnd.standard_normal((unit.shape[1], 8 * self.parts)) / self.w
        points, cost = np.zeros((len(y), 1, 0)), np.zeros((len(y), 1))
        for b in range(self.parts):
            own = y[:, 8 * b : 8 * b + 8]
            centre = nearest_e8(own)
            # squared distance to a neighbouring point, less that to the centre
            more = 2 - 2 * (own - centre) @ _ROOTS.T
            near = np.argpartition(more, self.probes - 1, axis=1)[:, : self.probes]
            choice = np.concatenate([centre[:, None, :], centre[:, None, :] + _ROOTS[near]], axis=1)
            added = np.concatenate([np.zeros((len(y), 1)), np.take_along_axis(more, near, 1)], axis=1)
            total = (cost[:, :, None] + added[:, None, :]).reshape(len(y), -1)
            best = np.argsort(total, axis=1, kind="stable")[:, : self.probes + 1]
            i, j = np.divmod(best, added.shape[1])
            points = np.concatenate([np.take_along_axis(points, i[:, :, None], 1), np.take_along_axis(choice, j[:, :, None], 1)], axis=2)
            cost = np.take_along_axis(total, best, 1)
        key = np.full(points.shape[:2], table + 1, np.uint64) * _M
        for c in np.moveaxis(np.rint(2 * points).astype(np.int64), 2, 0):
            key = _mixed(key ^ c.view(np.uint64))
        return key


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) + _M


def unit_rows(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of an Arrow list column, all of ``length``, over their norms."""
    m = np.asarray(column.flatten()).astype(np.float64).reshape(-1, length)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


# ---------------------------------------------------------------------------
# cells
# ---------------------------------------------------------------------------


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, vec): what takes part."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    sound = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    return v.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").where(sound)


def distinct_nodes(found: DataFrame) -> DataFrame:
    """Written (node, label, vec, least, copies): equal vectors of a label."""
    nodes = found.groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    return cut_lineage(nodes.select(F.monotonically_increasing_id().alias("node"), "label", "vec", "least", "copies"), "nodes")


def by_length(batch: pa.RecordBatch, rows: int = _ROWS) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Slices of a batch whose vectors have one length."""
    sizes = np.diff(np.asarray(batch.column("vec").offsets))
    for length in np.unique(sizes).tolist():
        at = np.nonzero(sizes == length)[0]
        for lo in range(0, len(at), rows):
            yield batch.take(pa.array(at[lo : lo + rows])), length


def postings(nodes: DataFrame, hashing: Hashing) -> DataFrame:
    """(cell, node): the cells of all tables that each node is posted in."""

    def task(batches):
        for batch in batches:
            for part, length in by_length(batch):
                unit = unit_rows(part.column("vec"), length)
                tag = _mixed(part.column("tag").to_numpy().view(np.uint64) ^ np.uint64(length))
                own = np.repeat(part.column("node").to_numpy(), hashing.probes + 1)
                for t in range(hashing.tables):
                    cell = _mixed(hashing.cells(unit, t) ^ tag[:, None])
                    yield pa.RecordBatch.from_arrays([pa.array(cell.ravel().view(np.int64)), pa.array(own)], names=["cell", "node"])

    tagged = spread(nodes).select("node", F.xxhash64("label").alias("tag"), "vec")
    return tagged.mapInArrow(frugal(task), "cell long, node long")


def shared_cells(posted: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Written (part, chunk, node): the cells of two members or more. Small cells are
    named by their members, so that equal ones fall together; larger ones keep
    their name and number their members chunk by chunk."""

    def task(batches):
        name, cells, members, size = None, [], [], 0  # the open cell; members not yet passed on

        def rows(group, chunks, nodes):
            return pa.RecordBatch.from_arrays([pa.array(group), pa.array(chunks), pa.array(nodes)], names=["part", "chunk", "node"])

        for batch in batches:
            cell, node = batch.column("cell").to_numpy(), batch.column("node").to_numpy()
            cuts = np.concatenate(([0], np.nonzero(np.diff(cell))[0] + 1, [len(cell)]))
            # a cell of one member inside the batch ends here; the first and last may go on
            runs = np.nonzero(np.diff(cuts) > 1)[0].tolist() if len(cell) else []
            runs = sorted({0, *runs, len(cuts) - 2}) if len(cell) else []
            small: list[np.ndarray] = []
            for lo, hi in ((int(cuts[r]), int(cuts[r + 1])) for r in runs):
                if name is not None and cell[lo] != name:
                    if size > chunk:
                        yield rows(np.full(len(members), name), np.arange(size - len(members), size) // chunk, members)
                    elif size > 1:
                        small.append(members)
                    name, members, size = None, [], 0
                members = np.concatenate([members, node[lo:hi]]).astype(np.int64) if len(members) else node[lo:hi]
                name, size = cell[lo], size + hi - lo
                if size > chunk:
                    yield rows(np.full(len(members), name), np.arange(size - len(members), size) // chunk, members)
                    members = np.zeros(0, np.int64)
            if small:
                yield rows(*_named(small))
        if name is not None and size > chunk and len(members):
            yield rows(np.full(len(members), name), np.arange(size - len(members), size) // chunk, members)
        elif name is not None and 1 < size <= chunk:
            yield rows(*_named([members]))

    # sorted by node as well: equal sets of members are listed alike
    sorted_ = posted.repartition("cell").sortWithinPartitions("cell", "node")
    found = sorted_.mapInArrow(frugal(task), "part long, chunk long, node long")
    return cut_lineage(found.distinct(), "cells")


def _named(groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(g) for g in groups])
    nodes = np.concatenate(groups)
    with np.errstate(over="ignore"):
        hashes = _mixed(nodes.view(np.uint64) + _M)
        names = np.add.reduceat(hashes, np.cumsum(sizes) - sizes)
    return np.repeat(names.view(np.int64), sizes), np.zeros(len(nodes), np.int64), nodes


# ---------------------------------------------------------------------------
# comparisons
# ---------------------------------------------------------------------------


def tiles(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(part, a, b, chunk, node, tag, copies, vec): the members of each pair of chunks (a <= b)
    of each part, with their vectors, together and in order."""
    crowded = cut_lineage(members.where("chunk > 0").groupBy("part").agg((F.max("chunk") + 1).alias("chunks")), "crowded")
    sized = members.join(broadcast_if_small(crowded, 1_000_000), "part", "left").fillna(1, ["chunks"])
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    dealt = sized.select("part", "chunk", "node", other)
    dealt = dealt.select("part", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "chunk", "node")
    own = nodes.select("node", F.xxhash64("label").alias("tag"), "copies", "vec")
    return dealt.join(own, "node").repartition("part", "a", "b").sortWithinPartitions("part", "a", "b", "chunk", "node")


def whole_tiles(batches) -> Iterator[pa.Table]:
    """The rows of one tile at a time."""
    held: list[pa.RecordBatch] = []
    open_key = None
    for batch in batches:
        keys = [batch.column(c).to_numpy() for c in ("part", "a", "b")]
        change = np.any([np.diff(k) != 0 for k in keys], axis=0)
        cuts = [0, *(np.nonzero(change)[0] + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            key = tuple(k[lo] for k in keys)
            if open_key is not None and key != open_key:
                yield pa.Table.from_batches(held)
                held = []
            open_key = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def links(tile: pa.Table, threshold: float) -> np.ndarray:
    """Boolean matrix of the links among a tile's rows; of a pair of different
    chunks only the links across."""
    n = tile.num_rows
    vec, tag, chunk = tile.column("vec").combine_chunks(), tile.column("tag").to_numpy(), tile.column("chunk").to_numpy()
    sizes = np.diff(np.asarray(vec.offsets))
    out = np.zeros((n, n), bool)
    for length in np.unique(sizes).tolist():
        at = np.nonzero(sizes == length)[0]
        unit = unit_rows(vec.take(pa.array(at)), length)
        cosine = unit @ unit.T
        linked = cosine >= threshold
        # a rounding of the product must not decide
        for i, j in np.argwhere(np.abs(cosine - threshold) < 1e-12).tolist():
            linked[i, j] = float((unit[min(i, j)] * unit[max(i, j)]).sum()) >= threshold
        out[np.ix_(at, at)] = linked
    out &= tag[:, None] == tag[None, :]
    if tile.column("a")[0] != tile.column("b")[0]:
        out &= chunk[:, None] != chunk[None, :]
    np.fill_diagonal(out, False)
    return out


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """(root, other) for every row that is not the first of its connected part."""
    free = np.ones(len(linked), bool)
    out = []
    for root in range(len(linked)):
        if not free[root]:
            continue
        free[root] = False
        stack = [root]
        while stack:
            new = np.nonzero(linked[stack.pop()] & free)[0]
            free[new] = False
            stack += new.tolist()
            out += [(root, int(x)) for x in new]
    return out


def linked_edges(cells: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Edges (u, v) that connect what is linked within each cell."""

    def task(batches):
        for tile in whole_tiles(batches):
            node = tile.column("node").to_numpy()
            pairs = forest(links(tile, threshold))
            if pairs:
                u, v = np.array(pairs).T
                yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], names=["u", "v"])

    return tiles(cells, nodes).mapInArrow(frugal(task), "u long, v long").distinct()


def link_counts(joined: DataFrame, nodes: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """(node, others): vectors linked to each node of a component, copies counted
    as often as they occur, its own copies left out."""
    sizes = joined.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    dealt = joined.join(sizes, "component").select(
        F.col("component").alias("part"), F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / chunk)).cast("long").alias("chunk"), "node"
    )

    def task(batches):
        for tile in whole_tiles(batches):
            copies = tile.column("copies").to_numpy()
            others = links(tile, threshold) @ copies
            yield pa.RecordBatch.from_arrays([tile.column("node").combine_chunks(), pa.array(others.astype(np.int64))], names=["node", "others"])

    found = tiles(cut_lineage(dealt, "members"), nodes).mapInArrow(frugal(task), "node long, others long")
    return found.groupBy("node").agg(F.sum("others").alias("others"))


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, probes: int = PROBES, chunk: int = CHUNK, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable), kept (is it that one)."""
    ship_package(vectors.sparkSession)
    found = usable(vectors, id_col, vec_col, label_col)
    nodes = distinct_nodes(found)
    largest = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    cells = shared_cells(postings(nodes, Hashing(largest, probes)), chunk)
    joined = cut_lineage(components(linked_edges(cells, nodes, threshold)), "components")
    least = joined.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    others = link_counts(joined, nodes, threshold, chunk)
    print_ = (F.xxhash64(F.lit(1), "vec").alias("h1"), F.xxhash64(F.lit(2), "vec").alias("h2"))
    named = (
        nodes.select("node", "label", *print_, "least", "copies")
        .join(joined.join(least, "component").select("node", "component_id"), "node", "left")
        .join(others, "node", "left")
        .select("label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    )
    named = cut_lineage(named, "named")
    rows = found.select("vec_id", "label", *print_).join(named, ["label", "h1", "h2"], "left").select("vec_id", "n_links", "component_id")
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    idle = _idle(every).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return rows.unionByName(idle).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _idle(every: DataFrame) -> DataFrame:
    """The rows that ``usable`` leaves out."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))) | ~F.exists("vec", lambda x: x != 0)
    return every.where("vec_id IS NULL OR label IS NULL OR vec IS NULL").unionByName(every.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").where(bad))
