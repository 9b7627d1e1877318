"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is run once to warm up the JVM and codegen caches, then timed
$BENCH_REPEATS times (default 3) by writing all rows and columns to the noop
sink; the median is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from segmetrics.plans import catalog as Q  # noqa: E402
from segmetrics.session import build_session  # noqa: E402

HEADLINE = [
    "count_all_segments",
    "metric_daily_rerun",
    "segment_errors",
    "account_profile",
    "account_seed",
    "metric_backfill",
    "segment_trend",
    "latency_summary",
    "latency_histogram_quantile",
]


def run(query, spark, sf_dir: str) -> None:
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app="segmetrics-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "6g"))
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    timings = {}
    for name in HEADLINE:
        q = Q.QUERIES[name]
        run(q, spark, sf_dir)                     # warm-up
        runs = []
        for _ in range(repeats):
            t = time.perf_counter()
            run(q, spark, sf_dir)
            runs.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
