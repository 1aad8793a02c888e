"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded, documented sample of the vectors (those with the smallest
hash of their id). Every vector is represented by its ``NEAREST`` nearest pivots
in order, and posted in their inverted files: per block of vectors, the file of a
pivot lists the vectors that have it among their nearest, with its rank there. A
query reads the files of its own nearest pivots only. The footrule distance,
with rank ``NEAREST`` for a pivot that one of the two does not list, is a constant
less twice the sum of ``NEAREST - max(rank in query, rank in vector)`` over the
pivots that both list, so those sums, added up over the files read, rank the
vectors; vectors in none of the files are not touched. The share ``depth`` of
each block with the smallest distance is reranked by the exact inner product in
double precision.

Vectors of different lengths are made comparable for the ordering by one more
component ``sqrt(max norm^2 - norm^2)`` (0 for queries), which leaves their
inner products with queries as they are and makes nearness a matter of angle.

The index is a written table of blocks; queries are a written table. A task
gathers index blocks up to ``GATHERED`` and streams the queries past them batch by
batch, so neither side passes through the driver, a task's memory does not grow
with either, and it passes on ``k`` rows per query and gathered piece. Tests measure
recall against brute force, and the share of vectors touched.

Edge cases: null, zero, null-holding and non-finite vectors and those of a
dimension other than the commonest take no part; a query finds all candidates
if there are fewer than ``k``; ties go to the smaller id; rows repeating an id
are candidates each, except for the query of that id; no vectors give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import frugal, hash_sample, open_folder
from weft.operators.side import write_side
from weft.session import scratch_path, ship_package, spread

PIVOTS, NEAREST = 512, 64
#: Share of a block that is reranked, and the least number over all blocks.
DEPTH, LEAST_DEPTH = 0.06, 1200
BLOCK = 8192
#: Index blocks a task gathers, and queries it reads at once.
GATHERED, QUERIES = 12, 256

#: ids and vectors of a block; its files one after another: rows of the block and
#: ranks, with the place where each pivot's file begins.
INDEX_SCHEMA = "ids binary, vectors binary, rows binary, ranks binary, starts binary, n int"


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id long, vec array<double>) of the vectors that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    sound = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    v = v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(sound)
    common = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return v.where(F.size("vec") == (common["d"] if common else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1).astype(np.float64) if len(column) else np.zeros((0, 0))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, m: int) -> np.ndarray:
    """Numbers (rows x m) of each vector's nearest pivots, nearest first."""
    near = vectors @ pivots.T
    if m < len(pivots):
        some = np.argpartition(-near, m - 1, axis=1)[:, :m]
    else:
        some = np.broadcast_to(np.arange(m), near.shape)
    order = np.lexsort((some, -np.take_along_axis(near, some, 1)), axis=1)
    return np.take_along_axis(some, order, 1)


def inverted_files(near: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, ranks and first places of the pivots' files of a block."""
    flat = near.ravel()
    order = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[order], np.arange(pivots + 1))
    return (order // near.shape[1]).astype("<u4"), (order % near.shape[1]).astype("<u2"), starts.astype("<i8")


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, longest**2 - (vectors**2).sum(axis=1)))
    return np.hstack([vectors, rest[:, None]])


class Index:
    """A written permutation index: folder, pivots, longest norm and size."""

    def __init__(self, path: str, pivots: np.ndarray, longest: float, n: int, m: int):
        self.path, self.pivots, self.longest, self.n, self.m = path, pivots, longest, n, m


class Block:
    """One block of the index as arrays."""

    def __init__(self, ids, vectors, rows, ranks, starts, n):
        self.ids = np.frombuffer(ids.as_buffer(), "<i8")
        self.vectors = np.frombuffer(vectors.as_buffer(), "<f8").reshape(n.as_py(), -1)
        self.rows, self.ranks, self.starts = np.frombuffer(rows.as_buffer(), "<u4"), np.frombuffer(ranks.as_buffer(), "<u2"), np.frombuffer(starts.as_buffer(), "<i8")

    def closeness(self, near: np.ndarray) -> np.ndarray:
        """Sum over the shared pivots of ``m - max(ranks)`` for each vector, from the
        files of the query's pivots alone: the larger, the smaller the footrule."""
        m = len(near)
        lo, hi = self.starts[near], self.starts[near + 1]
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        gain = m - np.maximum(np.repeat(np.arange(m), size), self.ranks[at])
        return np.bincount(self.rows[at], weights=gain, minlength=len(self.ids))

    def nearest(self, query: np.ndarray, own: int, near: np.ndarray, depth: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` of the ``depth`` vectors closest in footrule."""
        close = self.closeness(near)
        cand = np.argpartition(-close, depth - 1)[:depth] if depth < len(close) else np.arange(len(close))
        cand = cand[self.ids[cand] != own]
        # untouched vectors only stand in where the files hold too few
        if len(touched := cand[close[cand] > 0]) >= k:
            cand = touched
        # row-wise products: equal vectors get equal scores wherever they stand
        score = (self.vectors[cand] * query).sum(axis=1)
        best = np.lexsort((self.ids[cand], -score))[:k]
        return self.ids[cand][best], score[best]


def build_index(vectors: DataFrame, n_pivots: int = PIVOTS, block: int = BLOCK, nearest: int = NEAREST) -> Index | None:
    """Index every row of ``vectors`` (vec_id, vec); None if there is none."""
    spark = vectors.sparkSession
    ship_package(spark)
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    if not size["n"]:
        return None
    longest = float(np.sqrt(size["m"])) * (1 + 1e-12)
    sample = hash_sample(vectors, ["vec_id"], n_pivots, size["n"]).collect()
    pivots = _lifted(np.array([r["vec"] for r in sample], np.float64), longest)
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
    m = min(nearest, len(pivots))
    shared = spark.sparkContext.broadcast(pivots)

    def build(batches):
        ids, vecs, held = [], [], 0

        def row():
            own, mat = np.concatenate(ids), np.vstack(vecs)
            rows, ranks, starts = inverted_files(nearest_pivots(_lifted(mat, longest), shared.value, m), len(shared.value))
            columns = {"ids": own.astype("<i8"), "vectors": mat.astype("<f8"), "rows": rows, "ranks": ranks, "starts": starts}
            return pa.RecordBatch.from_pydict({**{c: [a.tobytes()] for c, a in columns.items()}, "n": pa.array([len(own)], pa.int32())})

        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                part = batch.slice(lo, block)
                ids.append(part.column("vec_id").to_numpy())
                vecs.append(_matrix(part.column("vec")))
                held += part.num_rows
                if held >= block:
                    yield row()
                    ids, vecs, held = [], [], 0
        if held:
            yield row()

    path = scratch_path(spark, "permutation-index")
    spread(vectors).mapInArrow(frugal(build), INDEX_SCHEMA).write.parquet(path)
    return Index(path, pivots, longest, size["n"], m)


def search(index: Index | None, queries: DataFrame, k: int = 20, depth: float = DEPTH, least_depth: int = LEAST_DEPTH) -> DataFrame:
    """For each row of ``queries`` (vec_id, vec) its ``k`` nearest other rows
    found: query_id, rank (from 1), vec_id, score."""
    spark = queries.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ship_package(spark)
    asked = write_side(queries.select("vec_id", "vec"), "queries")
    share, m = min(1.0, max(depth, least_depth / index.n)), index.m
    shared = spark.sparkContext.broadcast(index.pivots)

    def gathered(batches):
        held = []
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("ids", "vectors", "rows", "ranks", "starts", "n"))):
                held.append(Block(*row))
                if len(held) == GATHERED:
                    yield held
                    held = []
        if held:
            yield held

    def task(batches):
        import pyarrow.dataset as ds

        system, folder = open_folder(asked)
        source = ds.dataset(folder, filesystem=system, format="parquet", exclude_invalid_files=True)
        for blocks in gathered(batches):
            for part in source.to_batches(batch_size=QUERIES, batch_readahead=1, fragment_readahead=1):
                if not part.num_rows:
                    continue
                vectors = _matrix(part.column("vec"))
                near = nearest_pivots(np.hstack([vectors, np.zeros((len(vectors), 1))]), shared.value, m)
                out = []
                for own, query, pivots in zip(part.column("vec_id").to_pylist(), vectors, near):
                    found = [b.nearest(query, own, pivots, max(k + 1, int(np.ceil(share * len(b.ids)))), k) for b in blocks]
                    ids, score = (np.concatenate(c) for c in zip(*found))
                    best = np.lexsort((ids, -score))[:k]
                    out.append((np.full(len(best), own, np.int64), ids[best], score[best]))
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    found = spark.read.parquet(index.path).mapInArrow(frugal(task), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
