"""Count the reference's 5,000 generated segments against N generated
accounts (J5 + J6 + C1).

usage: python scripts/scale_run.py N [--cpus 8]
"""

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from segmetrics.operators import counting, seed  # noqa: E402
from segmetrics.session import build_session  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("n", type=int)
    ap.add_argument("--cpus", type=int, default=8)
    a = ap.parse_args()
    spark = build_session(f"local[{a.cpus}]", 2 * a.cpus, app="segmetrics-scale",
                          driver_memory="8g")
    accounts = seed.generate_accounts(
        spark.range(1, a.n + 1, numPartitions=max(8, a.n // 2_000_000))
        .withColumnRenamed("id", "user_id"))
    segments = seed.generate_segments(seed.segment_ids(spark, 5000))
    out = {"accounts": a.n, "segments": 5000}
    t = time.perf_counter()
    total, zero = counting.count_segments(accounts, segments).agg(
        F.sum("user_count"), F.count_if(F.col("user_count") == 0)).first()
    out |= {"seconds": round(time.perf_counter() - t, 2), "total": total, "zero": zero}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
