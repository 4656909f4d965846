"""Benchmark of the headline queries.

Runs each query fully (noop sink: every row is produced, nothing is
collected) on local[$BENCH_CPUS] over $BENCH_SF_DIR and prints one JSON line
with the warm median of $BENCH_REPS runs per query.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankforge.plans.registry import load_all  # noqa: E402
from rankforge.session import get_session  # noqa: E402

HEADLINE = [
    "eval_report", "dedup_last", "user_profiles", "item_features", "topn", "hybrid_blend",
    "item_knn", "ndcg_graded", "metrics_multi_k", "ab_stats", "mann_whitney_u",
    "request_summary", "latency_5m", "inflight", "metric_trend", "profile_asof",
    "session_features", "als_recs",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                        app_name="rankforge-bench",
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    times: dict[str, float] = {}
    for key in (only or HEADLINE):
        runs = []
        for _ in range(reps + 1):                       # first run warms up
            t0 = time.perf_counter()
            reg[key].run(spark, root).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[key] = round(statistics.median(runs[1:]), 3)
    m = re.search(r"sf([0-9.]+)", root)
    spark.stop()                     # no JVM output after the result line
    sys.stdout.flush()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else root,
                      "cpus": cpus, "reps": reps}))


if __name__ == "__main__":
    main()
