"""The daily metric run.

``run_day`` reproduces the reference's three steps for one day:

1. *init* (I1, C3, C4): a PENDING / 0 row for every segment that has no row for
   the day yet -- an anti join, existing rows are left as they are (R14);
2. *count* (I2, C2, C1): only rows still PENDING are counted, in one set-based
   job over just those segments; a row whose segment is gone, or whose
   definition is invalid, stays PENDING / 0 and is reported (R12, I6);
3. *mark completed* (I3): COUNTED becomes INSERTED, including COUNTED rows left
   over by a crashed run, which are not recounted (R15).

Counting checkpoints its inputs while the result is being built (see
``counting``); the rows themselves stay lazy.  The result is the day's complete partition plus ``segment_errors``.  A re-run
of a finished day counts nothing (every row is INSERTED), so it is a no-op even
if accounts changed since.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from zoneinfo import ZoneInfo

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import ZONE, materialize, own_checkpoints
from ..sources import tables
from .counting import count_segments

DAY_COLUMNS = ["segment_id", "metric_date", "user_count", "status"]


def day_rows(metrics: DataFrame, day: dt.date) -> DataFrame:
    """B19 without the status: the rows stored for ``day``."""
    return metrics.where(F.col("metric_date") == F.lit(day)).select(*DAY_COLUMNS)


def init_day(metrics: DataFrame, segments: DataFrame, day: dt.date) -> DataFrame:
    """Existing rows of the day plus a PENDING / 0 row per segment lacking
    one (insert-if-absent on (segment_id, metric_date))."""
    existing = day_rows(metrics, day)
    new = (segments.select("segment_id")
           .join(existing.select("segment_id"), "segment_id", "left_anti")
           .select("segment_id", F.lit(day).alias("metric_date"),
                   F.lit(0).cast("long").alias("user_count"),
                   F.lit(S.PENDING).alias("status")))
    return existing.unionByName(new)


def pending_page(rows: DataFrame, day: dt.date, page: int, size: int) -> DataFrame:
    """page ``page`` (0-based) of the day's PENDING rows by segment id."""
    return (rows.where((F.col("metric_date") == F.lit(day))
                       & (F.col("status") == S.PENDING))
            .orderBy("segment_id").offset(page * size).limit(size))


def count_results(rows: DataFrame, segments: DataFrame, accounts: DataFrame,
                  collation: str | None = None) -> DataFrame:
    """The day's rows after counting the PENDING ones, with
    ``error_reason`` for those that could not be counted (they stay PENDING / 0).
    The day's rows (one per segment) are checkpointed first: they feed the
    selection of segments to count and the join back, and reading the metric
    table once is enough."""
    rows = materialize(rows)
    pending = rows.where(F.col("status") == S.PENDING)
    done = rows.where(F.col("status") != S.PENDING).withColumn("error_reason", F.lit(None).cast("string"))
    wanted = segments.join(pending.select("segment_id"), "segment_id", "left_semi")
    counted = count_segments(accounts, wanted, collation)
    # ``counted`` has a row for every existing pending segment (valid or not),
    # so a pending row without a match is one whose segment is gone.
    joined = (pending.drop("user_count").join(counted, "segment_id", "left")
              .withColumn("reason", F.when(F.col("error_reason").isNotNull(),
                                           F.col("error_reason"))
                          .when(F.col("user_count").isNull(),
                                F.lit(S.SEGMENT_MISSING))))
    ok = F.col("reason").isNull()
    return done.unionByName(joined.select(
        "segment_id", "metric_date",
        F.when(ok, F.col("user_count")).otherwise(F.lit(0)).cast("long").alias("user_count"),
        F.when(ok, F.lit(S.COUNTED)).otherwise(F.lit(S.PENDING)).alias("status"),
        F.col("reason").alias("error_reason")))


def errors_of(results: DataFrame) -> DataFrame:
    return results.where(F.col("error_reason").isNotNull()).select("segment_id", "error_reason")


def count_step(rows: DataFrame, segments: DataFrame, accounts: DataFrame,
               collation: str | None = None) -> tuple[DataFrame, DataFrame]:
    """I2 as (day rows after the step, errors)."""
    results = count_results(rows, segments, accounts, collation)
    return results.select(*DAY_COLUMNS), errors_of(results)


def mark_completed(rows: DataFrame) -> DataFrame:
    """COUNTED -> INSERTED; everything else unchanged."""
    return rows.withColumn("status", F.when(F.col("status") == S.COUNTED, S.INSERTED)
                           .otherwise(F.col("status")))


def run_day(metrics: DataFrame, segments: DataFrame, accounts: DataFrame,
            day: dt.date, collation: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The full run for ``day``; returns (final day rows, errors)."""
    rows = init_day(metrics, segments, day)
    rows, errors = count_step(rows, segments, accounts, collation)
    return mark_completed(rows), errors


def today(zone: str = ZONE) -> dt.date:
    """H10: "today" in the zone of the daily schedule, whatever the session's."""
    return dt.datetime.now(ZoneInfo(zone)).date()


def execute_daily_batch(spark, accounts: DataFrame, segments: DataFrame, metrics_path: str,
                        day: dt.date | None = None, run_id: str | None = None, collation: str | None = None,
                        run_metrics_path: str | None = None) -> DataFrame:
    """I4 + A6 + I9: run one day against the stored, date-partitioned metric
    table and replace that day's partition: counts and reasons in one commit,
    so a run that breaks leaves the old day or the new one.  Returns
    ``run_metrics(run_id, stage, seconds, errors)``, appended to
    ``run_metrics_path`` if given: driver-side wall-clock of the stages (init,
    count, write, total) and the number of segments in error, which the write
    counts as it passes (no job of its own).  The per-chunk and per-segment
    timers of the reference have no counterpart: counting is one job.  The
    run's checkpoints are deleted at its end."""
    day = day or today()
    run_id = run_id or uuid.uuid4().hex[:12]
    clock = [time.perf_counter()]
    try:
        stored = tables.read_metrics(spark, metrics_path, day, day)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], S.METRIC)      # first run: no table yet
    with own_checkpoints(spark):
        rows = materialize(init_day(stored, segments, day))
        clock.append(time.perf_counter())
        results = materialize(mark_completed(count_results(rows, segments, accounts, collation)))
        clock.append(time.perf_counter())
        errors = tables.write_day(results, metrics_path)["errors"]
        clock.append(time.perf_counter())
    spent = [("init_step", clock[1] - clock[0]), ("count_step", clock[2] - clock[1]),
             ("flush", clock[3] - clock[2]), ("total", clock[3] - clock[0])]
    out = spark.createDataFrame([(run_id, s, float(round(v, 6)), errors) for s, v in spent],
                                "run_id string, stage string, seconds double, errors long")
    if run_metrics_path:
        out.write.mode("append").parquet(run_metrics_path)
    return out
