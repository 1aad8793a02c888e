"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed completely (a ``noop`` write of every row), after one
untimed warm-up job that starts the JVM and the Python workers. The figure is
the best of three runs; the two driver loops over many jobs run once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "workflow_plan",
    "refine_loop_model",
    "chunk_documents",
    "rag_top1",
    "rag_topk",
    "rag_dense_top1",
    "route_best",
    "route_respond",
    "rag_answer",
    "refine_loop",
    "plan_steps",
]


def runs_of(name: str) -> int:
    """The step chain and the refinement loop start dozens of jobs each."""
    return 1 if name in ("workflow_plan", "refine_loop_model") else 3


def warm_up(spark, sf_dir: str) -> None:
    """Untimed: start the JVM's code paths and one Python worker per core with
    the libraries the Arrow tasks import (long-lived on a cluster too)."""
    from weft.session import ship_package

    from weft.plans.catalog import QUERIES

    QUERIES["verdicts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    ship_package(spark)

    def touch(batches):
        import numpy  # noqa: F401
        import pyarrow  # noqa: F401

        import weft.operators.scoring  # noqa: F401

        yield from batches

    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).mapInArrow(touch, "id long").write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from weft.plans.catalog import QUERIES
    from weft.session import local_session

    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if str(cpus).isdigit() else 8, app="weft-bench")
    warm_up(spark, sf_dir)
    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(runs_of(name)):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
