"""Connected components of an edge table by alternating large and small stars.

Each step replaces edges by edges to the smallest neighbour; steps are written
to the shared checkpoint folder, so lineage stays short and an executor's loss
costs only its own tasks. Hub nodes are safe: minima are partial aggregates and
the join back to the edges is one that Spark splits when a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import cut_lineage


def _stars(edges: DataFrame) -> DataFrame:
    """Large star: every node sends its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_stars(edges: DataFrame) -> DataFrame:
    """Small star over edges with u > v: u and its smaller neighbours go to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the smallest node
    reachable. An empty table gives an empty result; self links are ignored."""
    current = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = cut_lineage(current, "edges")

    def state(df):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    before = state(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        current = cut_lineage(_small_stars(_stars(current)), "edges")
        after = state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
