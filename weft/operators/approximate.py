"""Approximate J1 for dense vectors by banded random-hyperplane signatures.

A signature holds the sides of ``bands x bits`` random hyperplanes a vector lies
on; the bits of a band are a key, and two vectors at a small angle agree on a
whole band with a good chance. Query keys, with those at the ``probes`` bits a
query is least sure of flipped, are an index of the streamed query block; every
corpus row looks its keys up there, and only pairs that share a key are scored,
exactly. So the corpus is scanned once, no pair leaves a task, and a task passes
on its running top k per query. What is missed are neighbours that share no key;
the share found (recall) depends on the angles, not on the size of the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.operators.scoring import BLOCK_QUERIES, DEFAULT_BLOCK_BYTES, _arrow_type, _dense_matrix, _ids, _list_parts
from weft.operators.side import prepared_blocks, write_side
from weft.session import ship_package

#: Bands and bits of each; flipped bits per band of a query.
BANDS, BITS, PROBES = 24, 12, 4
#: Corpus rows hashed at once, and candidate pairs scored at once.
_ROWS, _PAIRS = 4096, 262_144
_SEED = 12


def hyperplanes(dim: int, bands: int, bits: int) -> np.ndarray:
    return np.random.default_rng((_SEED, dim)).standard_normal((dim, bands * bits))


def band_keys(vectors: np.ndarray, planes: np.ndarray, bands: int, bits: int, probes: int = 0) -> np.ndarray:
    """Keys (rows x bands x (1 + probes)): band number and side bits."""
    side = (vectors @ planes).reshape(len(vectors), bands, bits)
    weight = (1 << np.arange(bits, dtype=np.int64))
    key = ((side > 0) * weight).sum(axis=2) + (np.arange(bands, dtype=np.int64) << bits)
    if not probes:
        return key[:, :, None]
    unsure = np.argsort(np.abs(side), axis=2, kind="stable")[:, :, :probes]
    return np.concatenate([key[:, :, None], key[:, :, None] ^ weight[unsure]], axis=2)


class QueryKeys:
    """The keys of a block of queries, in order, with their owners."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bands: int, bits: int, probes: int):
        norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.ids, self.unit = ids, vectors / np.where(norm > 0, norm, 1.0)[:, None]
        keys = band_keys(vectors, hyperplanes(vectors.shape[1], bands, bits), bands, bits, probes)
        keys[norm == 0] = -1  # a zero vector meets nothing
        flat = keys.reshape(-1)
        order = np.argsort(flat, kind="stable")
        self.keys, self.owner = flat[order], order // max(1, bands * (1 + probes))

    def candidates(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, query) pairs that share a key; ``keys``: rows x bands."""
        flat = keys.reshape(-1)
        lo, hi = np.searchsorted(self.keys, flat), np.searchsorted(self.keys, flat, side="right")
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        pair = np.unique(np.repeat(np.arange(len(flat)) // keys.shape[1], size) * len(self.ids) + self.owner[at])
        return pair // max(1, len(self.ids)), pair % max(1, len(self.ids))


def _best(found: list[tuple], k: int) -> tuple:
    """The best ``k`` rows per query of (query, similarity, ids...) columns."""
    q, sim, *ids = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((*reversed(ids), -np.round(sim, 9), q))
    q = q[order]
    start = np.searchsorted(q, q)
    keep = order[np.arange(len(q)) - start < k]
    return tuple([np.concatenate(c)[keep] for c in zip(*found)])


def approx_top_k(
    queries: DataFrame, q_id: str, corpus: DataFrame, c_ids: Sequence[str], vec_col: str = "vec", k: int = 1,
    bands: int = BANDS, bits: int = BITS, probes: int = PROBES, exclude_self: bool = False, with_rank: bool = False,
) -> DataFrame:
    """As ``top_k_matches(kind='dense')``, among the corpus rows that share a key with
    the query: q_id, c_ids..., similarity[, rank]. NULL and zero vectors meet nothing;
    ties and order are those of the exact form. Ids are integers or strings."""
    if k < 1 or bands < 1 or not 0 < bits < 40 or not 0 <= probes <= bits:
        raise ValueError("k and bands must be >= 1, bits between 1 and 39, probes at most bits")
    ship_package(queries.sparkSession)
    c_ids = list(c_ids)
    path = write_side(queries.where(F.col(vec_col).isNotNull()).select(q_id, F.col(vec_col).alias("_v")), "queries")
    fields = [T.StructField(f.name, f.dataType) for f in (queries.schema[q_id], *(corpus.schema[c] for c in c_ids))] + [T.StructField("similarity", T.DoubleType())]
    schema = pa.schema([*(pa.field(f.name, _arrow_type(f.dataType)) for f in fields[:-1]), pa.field("similarity", pa.float64())])

    def prepare(block: pa.Table) -> QueryKeys:
        return QueryKeys(_ids(block.column(q_id)), _dense_matrix(*_list_parts(block.column("_v"))), bands, bits, probes)

    def scored(block: QueryKeys, vectors: np.ndarray, ids: list[np.ndarray], keys: np.ndarray):
        row, query = block.candidates(keys)
        for lo in range(0, len(row), _PAIRS):
            r, q = row[lo : lo + _PAIRS], query[lo : lo + _PAIRS]
            sim = np.einsum("ij,ij->i", vectors[r], block.unit[q])
            keep = np.ones(len(r), bool) if not exclude_self else ids[0][r] != block.ids[q]
            yield (q[keep], sim[keep], *(a[r][keep] for a in ids))

    def task(batches):
        best: dict[int, tuple] = {}
        owners: dict[int, np.ndarray] = {}
        planes = None
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                part = batch.slice(lo, _ROWS)
                offsets, flat, valid = _list_parts(part.column(vec_col))
                vectors = _dense_matrix(offsets, flat, valid)
                norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
                some = np.nonzero(norm > 0)[0]
                if not len(some):
                    continue
                vectors = vectors[some] / norm[some, None]
                ids = [_ids(part.column(c))[some] for c in c_ids]
                if planes is None:
                    planes = hyperplanes(vectors.shape[1], bands, bits)
                keys = band_keys(vectors, planes, bands, bits)[:, :, 0]
                for b, block in enumerate(prepared_blocks(path, prepare, BLOCK_QUERIES, "_v", DEFAULT_BLOCK_BYTES // 8)):
                    found = list(scored(block, vectors, ids, keys))
                    if found:
                        owners[b] = block.ids
                        best[b] = _best([*([best[b]] if b in best else []), *found], k)
        for b, (q, sim, *ids) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(c.tolist(), f.type) for c, f in zip((owners[b][q], *ids, sim), schema)], schema=schema)

    partials = corpus.where(F.col(vec_col).isNotNull()).select(*c_ids, vec_col).mapInArrow(task, T.StructType(fields))
    order = Window.partitionBy(q_id).orderBy(F.desc(F.round("similarity", 9)), *[F.asc(c) for c in c_ids])
    ranked = partials.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(q_id, *c_ids, "similarity", *(["rank"] if with_rank else []))
