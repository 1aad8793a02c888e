"""Approximate top-k beside the exact form."""

import numpy as np
import pytest

from weft.operators.approximate import QueryKeys, approx_top_k, band_keys, hyperplanes
from weft.operators.scoring import top_k_matches


def clustered(n, groups, seed=1, dim=48, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * spread


def test_recall_and_scores_beside_the_exact_form(spark):
    x = clustered(4000, 200)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 48)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    q = df.where("vec_id % 40 = 0 OR vec_id >= 9000").withColumnRenamed("vec_id", "id")
    exact = {}
    for r in top_k_matches(q, "id", df, ["vec_id"], kind="dense", k=10, exclude_self=True).collect():
        exact.setdefault(r["id"], {})[r["vec_id"]] = r["similarity"]
    got = {}
    for r in approx_top_k(q, "id", df.repartition(5), ["vec_id"], k=10, exclude_self=True, with_rank=True).collect():
        got.setdefault(r["id"], {})[r["vec_id"]] = r["similarity"]
        assert r["rank"] <= 10
    assert set(got) <= set(exact) and len(exact) == 100
    recall = np.mean([len(set(got.get(i, ())) & set(own)) / 10 for i, own in exact.items()])
    assert recall >= 0.9
    assert all(abs(s - exact[i][v]) < 1e-9 for i, own in got.items() for v, s in own.items() if v in exact[i])


def test_few_pairs_are_scored():
    """The share of all pairs that share a key, on vectors in clusters."""
    x = clustered(4000, 200, seed=2)
    block = QueryKeys(np.arange(100), x[:100], 24, 12, 4)
    row, query = block.candidates(band_keys(x, hyperplanes(48, 24, 12), 24, 12)[:, :, 0])
    assert len(row) < 0.2 * 4000 * 100 and len(set(zip(row.tolist(), query.tolist()))) == len(row)
    # a vector shares all its keys with itself
    assert {(i, i) for i in range(100)} <= set(zip(row.tolist(), query.tolist()))


def test_ties_copies_and_empty_tables(spark):
    df = spark.createDataFrame([(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0])], "vec_id long, vec array<double>")
    q = spark.createDataFrame([("a", [5.0, 0.0]), ("b", None), ("c", [0.0, 0.0])], "id string, vec array<double>")
    assert [tuple(r) for r in approx_top_k(q, "id", df, ["vec_id"], k=2, with_rank=True).orderBy("rank").collect()] == [("a", 1, 1.0, 1), ("a", 2, 1.0, 2)]
    assert approx_top_k(q.limit(0), "id", df, ["vec_id"]).count() == 0 and approx_top_k(q, "id", df.limit(0), ["vec_id"]).count() == 0
    with pytest.raises(ValueError):
        approx_top_k(q, "id", df, ["vec_id"], bits=40)
