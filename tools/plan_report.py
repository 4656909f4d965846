"""Summarise the physical plan of every registered query (PLANS.md).

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Streaming queries are skipped (their plans live inside the stream).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankforge.plans.registry import load_all  # noqa: E402
from rankforge.session import get_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct")


def main():
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8, app_name="rankforge-plans")
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans (summary)\n")
    print(f"Generated by `tools/plan_report.py` on `{root}` (local[8], AQE on; initial plan "
          "before adaptive re-optimisation).  Exchanges = shuffles (incl. broadcast "
          "exchanges); Py = Arrow pandas stage present; pushed = filters pushed into a "
          "parquet scan.\n")
    print("| query | exchanges | joins | aggregates | windows | Py | pushed filters |")
    print("|---|---|---|---|---|---|---|")
    for key, q in load_all().items():
        if key.startswith("stream_"):
            continue
        try:
            plan = q.run(spark, root)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"| {key} | error: {type(e).__name__} | | | | | |")
            continue
        joins = sorted({j for j in JOINS if j in plan})
        pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]+)\]", plan)
                         if p and not all(x.startswith("IsNotNull") for x in p.split(", "))})
        py = any(s in plan for s in ("ArrowEvalPython", "FlatMapGroupsInPandas",
                                     "MapInPandas", "BatchEvalPython"))
        aggs = len(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", plan))
        wins = len(re.findall(r"\bWindow(GroupLimit)?\b", plan))
        print(f"| {key} | {plan.count('Exchange')} | {', '.join(joins) or '-'} | {aggs} | "
              f"{wins} | {'yes' if py else '-'} | {'; '.join(pushed)[:90] or '-'} |")


if __name__ == "__main__":
    main()
