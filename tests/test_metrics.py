"""Trace metrics and mergeable quantile sketches."""

import random

import pytest
from pyspark.sql import functions as F

from weft.operators.metrics import SKETCH_K, loop_metrics, loop_partials, margin, margin_partials, quantiles, roll_up


def test_loop_metrics_roll_up(spark):
    rows = [("a", 1, 1, True, "x"), ("a", 2, 1, False, None), ("a", 2, 2, True, "yy"), ("b", 3, 1, False, "z"), ("b", 3, 2, False, "z")]
    trace = spark.createDataFrame(rows, "run string, prompt_id long, iteration int, accepted boolean, response string")
    kept = loop_partials(trace, ["run"])
    got = {r["run"]: tuple(r)[1:] for r in loop_metrics(kept, ["run"]).collect()}
    assert got == {"a": (2, 1.0, 0.5, 1.5), "b": (1, 0.0, None, 2.0)}
    whole = loop_metrics(kept).first()
    assert (whole["prompts"], round(whole["acceptance_rate"], 6), whole["mean_iterations"]) == (3, 0.666667, 5 / 3)
    assert loop_metrics(loop_partials(trace.limit(0), ["run"]), ["run"]).count() == 0


@pytest.mark.parametrize("groups", [1, 40])
def test_quantiles_are_within_the_stated_error_after_merging(spark, groups):
    rnd = random.Random(groups)
    values = [rnd.choice((rnd.random(), rnd.gauss(5, 1), 0.5)) for _ in range(20_000)]
    df = spark.createDataFrame([(i % groups, v) for i, v in enumerate(values)] + [(0, None)], "g long, v double").repartition(16)
    kept = margin_partials(df, "v", ["g"])
    whole = roll_up(kept)
    values.sort()
    for r in quantiles(whole, (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)).collect():
        below, upto = sum(v < r["quantile"] for v in values), sum(v <= r["quantile"] for v in values)
        slack = 2.5 / SKETCH_K * len(values) + 1
        assert below - slack <= r["probability"] * len(values) <= upto + slack
        assert r["n"] == len(values) and abs(r["mean"] - sum(values) / len(values)) < 1e-9 and (r["least"], r["greatest"]) == (values[0], values[-1])
    assert quantiles(margin_partials(df.limit(0), "v", ["g"]), (0.5,)).count() == 0


def test_margin(spark):
    scores = "array<struct<route_pos:int,similarity:double>>"
    df = spark.createDataFrame([(1, [(0, 0.2), (1, 0.9), (2, None)]), (2, [(0, 0.2)]), (3, []), (4, None), (5, [(0, 0.3), (1, 0.3)]), (6, [(0, float("nan")), (1, 0.5), (2, 0.25)])], f"id int, scores {scores}")
    got = {r["id"]: r["m"] for r in df.select("id", margin(F.col("scores")).alias("m")).collect()}
    assert got == {1: pytest.approx(0.7), 2: None, 3: None, 4: None, 5: 0.0, 6: 0.25}
