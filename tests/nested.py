"""The plain way to count: every valid definition against every cell, for tests."""

from pyspark.sql import functions as F

from segmetrics.functions import conditions as C
from segmetrics.operators.counting import COLUMNS, account_cells


def nested_counts(accounts, segments, collation=None):
    norm = C.normalize_segments(segments, collation).withColumn("def_key", F.to_json("effective"))
    cells = account_cells(accounts)
    defs = norm.where(F.col("error_reason").isNull()).dropDuplicates(["def_key"]).select("def_key", "effective")
    row = {c: F.col(c) for c in COLUMNS}
    counts = (defs.join(cells, C.all_match(F.col("effective"), row, collation))
              .groupBy("def_key").agg(F.sum("n").cast("long").alias("user_count")))
    out = norm.select("segment_id", "error_reason", "def_key").join(counts, "def_key", "left")
    return {r.segment_id: (r.user_count or 0 if r.error_reason is None else 0, r.error_reason) for r in out.collect()}
