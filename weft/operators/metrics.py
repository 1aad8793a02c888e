"""Metrics over traces, as partial tables that roll up without a rescan.

``loop_partials`` and ``margin_partials`` reduce a trace to one small row per group
(a run, a day, a route ...): counts, sums and a mergeable quantile sketch of a value.
``roll_up`` merges such rows to coarser groups, whoever wrote them and when;
``quantiles`` reads them. Aggregation is partial before every shuffle, so a group
that holds most rows costs one row per task.

Quantiles are those of a KLL sketch: the rank of a returned value is off by about
``2.3 / SKETCH_K`` at most (99 % of the time), merged or not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; its rank error is about 2.3 / SKETCH_K.
SKETCH_K = 800


def loop_partials(trace: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per ``keys`` and iteration of a refinement trace: prompts ``asked``, prompts
    ``accepted`` and characters answered."""
    return trace.groupBy(*keys, "iteration").agg(
        F.count(F.lit(1)).alias("asked"), F.sum(F.col("accepted").cast("long")).alias("accepted"),
        F.sum(F.coalesce(F.length("response"), F.lit(0)).cast("long")).alias("chars"))


def loop_metrics(partials: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per ``keys`` of rows of ``loop_partials``: prompts, share accepted, share of
    the accepted that the first round gave, and mean iterations (every prompt is
    asked once per round it takes part in)."""
    first = F.col("iteration") == 1
    total = lambda c, when=None: F.sum(F.when(when, F.col(c)).otherwise(0) if when is not None else F.col(c))
    return partials.groupBy(*keys).agg(
        total("asked", first).alias("prompts"),
        F.try_divide(total("accepted"), total("asked", first)).alias("acceptance_rate"),
        F.try_divide(total("accepted", first), total("accepted")).alias("accepted_at_once"),
        F.try_divide(total("asked"), total("asked", first)).alias("mean_iterations"))


def margin(scores: Column | str) -> Column:
    """How far the best score of a routed prompt (``score_routes``) stands above the
    next one; NULL with fewer than two."""
    c = F.col(scores) if isinstance(scores, str) else scores
    order = F.reverse(F.array_sort(F.filter(F.transform(c, lambda s: s["similarity"]), lambda x: x.isNotNull() & ~F.isnan(x))))
    return F.when(F.size(order) > 1, F.element_at(order, 1) - F.element_at(order, 2))


def margin_partials(values: DataFrame, value: str, keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Per ``keys``: ``n``, ``total``, least and greatest of a column of doubles
    (NULLs left out), and its sketch."""
    v = F.col(value).cast("double")
    return values.where(v.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("greatest"),
        F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def roll_up(partials: DataFrame, keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Rows of ``margin_partials`` merged to the coarser ``keys``."""
    return partials.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.kll_merge_agg_double(F.col("sketch"), F.lit(k)).alias("sketch"))


def quantiles(partials: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """One row per row of ``partials`` and probability: its other columns, ``mean``,
    ``probability`` and ``quantile``."""
    kept = [c for c in partials.columns if c not in ("sketch", "total")]
    at = [F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probabilities]
    return partials.select(*kept, (F.col("total") / F.col("n")).alias("mean"), F.inline(F.array(*at)))
