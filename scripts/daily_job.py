"""Run one day of the segment metrics: a main for spark-submit.

usage: spark-submit --conf spark.checkpoint.dir=<shared folder> scripts/daily_job.py
       --accounts PATH --segments PATH --metrics PATH [--run-metrics PATH] [--close-months]
       [--day YYYY-MM-DD] [--zone Asia/Seoul] [--collation NAME]
"""

import argparse
import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from segmetrics.operators import daily  # noqa: E402
from segmetrics.session import ZONE  # noqa: E402
from segmetrics.sources import tables  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser()
    for name in ("accounts", "segments", "metrics"):
        ap.add_argument(f"--{name}", required=True)
    ap.add_argument("--close-months", action="store_true", help="store the months before the day's as sorted files")
    for name in ("run-metrics", "collation"):
        ap.add_argument(f"--{name}")
    ap.add_argument("--day", type=dt.date.fromisoformat)
    ap.add_argument("--zone", default=ZONE)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("segmetrics-daily").getOrCreate()
    day = a.day or daily.today(a.zone)
    daily.execute_daily_batch(
        spark, tables.read_accounts(spark, a.accounts), tables.read_segments(spark, a.segments), a.metrics,
        day=day, collation=a.collation, run_metrics_path=a.run_metrics).show(truncate=False)
    if a.close_months:
        tables.close_months_before(spark, a.metrics, day)


if __name__ == "__main__":
    main()
