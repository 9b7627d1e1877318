"""Run a registered query and print its final (adaptive) physical plan.

usage: python scripts/explain_query.py QUERY [sf_dir]

The DataFrame's own plan is executed once so AQE's runtime decisions --
broadcast vs shuffle joins, coalesced partitions, skew splits -- appear in
the printed plan.  Diagnostic use at small scale only (the rows are
collected to the driver).
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from segmetrics.plans.catalog import QUERIES  # noqa: E402
from segmetrics.session import build_session  # noqa: E402


def main():
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, app="segmetrics-explain")
    df = QUERIES[name](spark, sf)
    df._jdf.queryExecution().executedPlan().execute().count()      # finalizes the adaptive plan
    df.explain("formatted")


if __name__ == "__main__":
    main()
