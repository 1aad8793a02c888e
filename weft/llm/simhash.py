"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of a text's
word shingles. Documents are reduced to distinct fingerprints, each represented
by its smallest doc_id. With ``distance`` differing bits allowed, a fingerprint
is split into ``distance + 2`` blocks: two close ones then agree on at least two
whole blocks, so the join key is a pair of blocks (number of the pair and its
bits), far more selective than a single block. Fingerprints that share a key
are compared by Hamming distance.

A key shared by more than ``dense`` fingerprints is not joined: there each
fingerprint lists itself and its neighbours at one flipped bit outside the two
blocks. Two fingerprints list the same value only if they differ in at most two
bits, and all that do list one, so linking every lister of a value to the
smallest of them loses no component and makes ``rows x 64`` links at most, where
a join would make the square. (This holds for ``distance`` 2, the contract's;
other distances join all keys.)

Edge cases: a null or blank text has fingerprint zero and is linked like any
other; fewer words than a shingle: the whole sequence is one shingle; a bit set
in exactly half the hashes is 0; repeated rows give repeated results; rows with
a null doc_id keep their fingerprint and get the component of their
fingerprint, null if it has no other row; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import frugal, texts
from weft.llm.components import components
from weft.session import cut_lineage, ship_package

SHINGLE, DISTANCE, SEED = 3, 2, 42
#: Fingerprints of a block key that are still compared pair by pair.
DENSE = 64
#: Shingle hashes counted in one go.
_HASHES = 65_536


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint; words are separated by ASCII white space and
    only A-Z are lower-cased (what ``bytes.split`` and ``bytes.lower`` do)."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), _HASHES):
        bits = np.unpackbits(hashes[lo : lo + _HASHES].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.nonzero(2 * ones > len(hashes))[0].tolist()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id long, fp long): the fingerprint's bits as a signed long."""
    ship_package(docs.sparkSession)

    def task(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle, seed) for t in texts(batch.column("text"))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(frugal(task), "doc_id long, fp long")


def _block_masks(distance: int) -> list[int]:
    """Masks of the pairs of blocks (unsigned)."""
    n = distance + 2
    bounds = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(bounds, bounds[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def close_pairs(nodes: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """Links (u, v) between the ``node`` values of distinct fingerprints (node,
    fp) at most ``distance`` bits apart: every such pair of a sparse block key,
    and enough of a dense one's to connect the same components."""
    masks = _block_masks(distance)
    keys = F.array(*[F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for i, m in enumerate(masks)])
    listed = nodes.select("node", "fp", F.inline(keys))
    sizes = listed.groupBy("pair", "bits").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = cut_lineage(listed.join(sizes, ["pair", "bits"]), "blocks")
    limit = dense if distance == 2 else 2**62
    sparse = shared.where(F.col("size") <= limit)
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= distance
    right = sparse.select("pair", "bits", F.col("node").alias("v"), F.col("fp").alias("fp2"))
    pairs = sparse.join(right, ["pair", "bits"]).where((F.col("node") > F.col("v")) & near).select(F.col("node").alias("u"), "v")
    if distance != 2:
        return pairs.distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    outside = F.array(*[F.array(F.lit(-1), *[F.lit(i) for i in range(64) if not m >> i & 1]) for m in masks])
    chosen = F.transform(F.element_at(outside, F.col("pair") + 1), lambda i: F.element_at(flips, i + 2))
    centres = shared.where(F.col("size") > limit).select("node", "fp", F.explode(chosen).alias("centre"))
    centres = centres.select("node", "fp", "centre").distinct()
    head = centres.groupBy("centre").agg(F.min(F.struct("node", "fp")).alias("head"), F.count(F.lit(1)).alias("listers")).where("listers > 1")
    stars = centres.join(head.select("centre", F.col("head.node").alias("v"), F.col("head.fp").alias("fp2")), "centre")
    stars = stars.where((F.col("node") > F.col("v")) & near).select(F.col("node").alias("u"), "v")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED, dense: int = DENSE) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``."""
    prints = cut_lineage(fingerprints(docs, shingle, seed), "fingerprints")
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    found = components(close_pairs(nodes.where("node IS NOT NULL"), distance, dense))
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED, dense: int = DENSE) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest
    doc_id; rows repeating its id are dropped too, rows with a null id stay."""
    found = cut_lineage(near_duplicates(docs, shingle, distance, seed, dense).select("doc_id", "component_id").where("doc_id IS NOT NULL"), "components")
    kept = docs.join(found.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    again = cut_lineage(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if again.isEmpty():
        return kept
    once = kept.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)
