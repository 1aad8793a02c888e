"""Summarise the physical plans of the registered queries: what each scan
reads, how many shuffles, which joins, where Python runs.

    python scripts/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\(\d+ paths?\)\[[^\]]*/([a-z_]+)\.parquet\]", plan)
    return {
        "scans": sorted({f"{t}({cols})" for cols, t in ((re.sub(r"#\d+L?", "", c), t) for c, t in scans)}),
        "shuffles": len(re.findall(r"\bExchange (hashpartitioning|RoundRobinPartitioning|rangepartitioning|SinglePartition)", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan))),
        "python": sorted(set(re.findall(r"(MapInArrow|MapInPandas|ArrowEvalPython|BatchEvalPython)", plan))),
        "limits": sorted(set(re.findall(r"(WindowGroupLimit|GlobalLimit|CollectLimit|TakeOrderedAndProject)", plan))),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from weft.plans.catalog import QUERIES
    from weft.session import local_session

    spark = local_session()
    print(f"# Physical plans ({os.path.basename(sf_dir)}, before adaptive re-planning)\n")
    print("Generated by `scripts/plan_summary.py`. Shuffles count `Exchange` nodes; tables written to the checkpoint folder")
    print("by a query (lineage cuts) appear as scans of `tables/...`, which are not listed.\n")
    print("| Query | Parquet scans (columns read) | Shuffles | Broadcasts | Joins | Python | Limits |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | {'; '.join(s['scans']) or '-'} | {s['shuffles']} | {s['broadcasts']} | "
              f"{', '.join(s['joins']) or '-'} | {', '.join(s['python']) or '-'} | {', '.join(s['limits']) or '-'} |")


if __name__ == "__main__":
    main()
