"""Named queries over the driver's test tables: ``(spark, sf_dir) -> DataFrame``.

Each query reads the given parquet tables (or tables Spark derives from them
in ``sources.derived``), so its work grows with them.  Column names equal the
oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import conditions as C
from ..operators import counting, daily, latency, quality, seed, segments, trend
from ..session import scratch_path
from ..sources import derived as D
from ..sources import tables

RUN_DAY = D.RUN_DAY
TREND_SEGMENT, TREND_START, TREND_END = 1, "2026-02-01", "2026-03-15"
PROBE_DAYS = [dt.date(2026, 1, 1), dt.date(2026, 4, 30), RUN_DAY, dt.date(2026, 6, 1)]
PAGE, PAGE_SIZE = 2, 100
AFTER_SEGMENT = 150
BEHIND_LAST = 10**12
CLOSE_BEFORE = dt.date(2026, 4, 30)
SEED_AS_OF = dt.datetime(2026, 5, 1)

# One condition per single-predicate query (B2-B11) and the full fixture 10.
SINGLE_PREDICATES = {
    "pred_str_eq": ("location", "EQUALS", "NATION_3"),
    "pred_str_ne": ("gender", "NOT_EQUALS", "MALE"),
    "pred_str_contains": ("location", "CONTAINS", "TION_2"),
    "pred_str_prefix": ("location", "STARTS_WITH", "NATION_1"),
    "pred_int_eq": ("age", "EQUALS", "30"),
    "pred_int_ne": ("age", "NOT_EQUALS", "30"),
    "pred_int_gt": ("order_count", "GT", "10"),
    "pred_int_gte": ("age", "GTE", "50"),
    "pred_int_lt": ("age", "LT", "30"),
    "pred_int_lte": ("order_count", "LTE", "5"),
}
ONE_SEGMENT = [("location", "EQUALS", "NATION_3"), ("gender", "EQUALS", "FEMALE"),
               ("age", "GTE", "30"), ("order_count", "GTE", "10")]
COLLATION_CONDITIONS = [("gender", "EQUALS", "male"), ("location", "CONTAINS", "tion_2")]


def _conds(items):
    return [{"category": c, "operator": o, "value": v} for c, o, v in items]


def account_profile(spark: SparkSession, sf: str) -> DataFrame:
    return D.accounts(spark, sf)


def segment_parse(spark: SparkSession, sf: str) -> DataFrame:
    return C.exploded_conditions(D.workload_segments(spark, sf))


def segment_normalize(spark: SparkSession, sf: str) -> DataFrame:
    norm = C.normalize_segments(D.workload_segments(spark, sf))
    return norm.where(F.col("error_reason").isNull()).select(
        "segment_id", "signature", F.size("effective").alias("n_conditions"),
        "age_lo", "age_hi", F.col("order_count_lo"), F.col("order_count_hi"))


def segment_errors(spark: SparkSession, sf: str) -> DataFrame:
    norm = C.normalize_segments(D.workload_segments(spark, sf))
    return norm.where(F.col("error_reason").isNotNull()).select("segment_id", "error_reason")


def _single(key):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        acc = D.accounts(spark, sf)
        return acc.where(counting.predicate(_conds([SINGLE_PREDICATES[key]])))
    q.__name__ = key
    return q


def pred_collation_ci_ai(spark: SparkSession, sf: str) -> DataFrame:
    acc = D.accounts(spark, sf)
    return acc.where(counting.predicate(_conds(COLLATION_CONDITIONS), "UNICODE_CI_AI"))


def count_all_segments(spark: SparkSession, sf: str) -> DataFrame:
    return counting.count_segments(D.accounts(spark, sf), D.workload_segments(spark, sf))


def count_all_segments_ci(spark: SparkSession, sf: str) -> DataFrame:
    """C1 with the reference database's case- and accent-insensitive
    string matching (B17)."""
    return counting.count_segments(D.accounts(spark, sf), D.workload_segments(spark, sf),
                                   collation="UNICODE_CI_AI")


def count_match_all(spark: SparkSession, sf: str) -> DataFrame:
    """Segments whose definition keeps no effective condition (R2, R3, R4):
    each counts every account."""
    segs = D.workload_segments(spark, sf)
    norm = C.normalize_segments(segs)
    match_all = norm.where(F.col("error_reason").isNull() & (F.col("signature") == 0))
    chosen = segs.join(match_all.select("segment_id"), "segment_id", "left_semi")
    return counting.count_segments(D.accounts(spark, sf), chosen).select(
        "segment_id", "user_count")


def count_one_segment(spark: SparkSession, sf: str) -> DataFrame:
    return counting.count_one(D.accounts(spark, sf), _conds(ONE_SEGMENT))


def segment_seed(spark: SparkSession, sf: str) -> DataFrame:
    """J6 with the reference's own regions; one definition per customer,
    ladder step (7k % 5000) + 1."""
    keys = D.customer_keys(spark, sf).select(
        (F.col("k") + 1).alias("segment_id"),
        ((F.col("k") * 7) % D.LADDER_STEPS + 1).alias("step"))
    segs = seed.generate_segments(keys, step_col="step", as_of=SEED_AS_OF)
    return segs.select("segment_id", "conditions",
                       F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                       F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


def account_seed(spark: SparkSession, sf: str) -> DataFrame:
    """Synthetic demographics for every customer id (user_id = key + 1)."""
    ids = D.customer_keys(spark, sf).select((F.col("k") + 1).alias("user_id"))
    return seed.generate_accounts(ids)


def metric_backfill(spark: SparkSession, sf: str) -> DataFrame:
    return D.history(spark, sf)


def _metrics_with_crash(spark, sf):
    return D.history(spark, sf).unionByName(D.crash_day(spark, sf))


def metric_init_day(spark: SparkSession, sf: str) -> DataFrame:
    return daily.init_day(_metrics_with_crash(spark, sf), D.workload_segments(spark, sf),
                          RUN_DAY)


def metric_pending_page(spark: SparkSession, sf: str) -> DataFrame:
    rows = daily.init_day(_metrics_with_crash(spark, sf), D.workload_segments(spark, sf),
                          RUN_DAY)
    return daily.pending_page(rows, RUN_DAY, PAGE, PAGE_SIZE)


def metric_count_day(spark: SparkSession, sf: str) -> DataFrame:
    segs = D.workload_segments(spark, sf)
    rows = daily.init_day(_metrics_with_crash(spark, sf), segs, RUN_DAY)
    after, _ = daily.count_step(rows, segs, D.accounts(spark, sf))
    return after


def metric_mark_completed(spark: SparkSession, sf: str) -> DataFrame:
    return daily.mark_completed(D.crash_day(spark, sf))


def metric_daily_run(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = daily.run_day(D.history(spark, sf), D.workload_segments(spark, sf),
                            D.accounts(spark, sf), RUN_DAY)
    return rows


def metric_daily_rerun(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = daily.run_day(_metrics_with_crash(spark, sf), D.workload_segments(spark, sf),
                            D.accounts(spark, sf), RUN_DAY)
    return rows


def metric_run_errors(spark: SparkSession, sf: str) -> DataFrame:
    _, errors = daily.run_day(_metrics_with_crash(spark, sf), D.workload_segments(spark, sf),
                              D.accounts(spark, sf), RUN_DAY)
    return errors


def metric_exists_day(spark: SparkSession, sf: str) -> DataFrame:
    return quality.day_presence(spark, _metrics_with_crash(spark, sf), PROBE_DAYS)


def segment_trend(spark: SparkSession, sf: str) -> DataFrame:
    return trend.trend(D.history(spark, sf), TREND_SEGMENT, TREND_START, TREND_END)


def segment_trends(spark: SparkSession, sf: str) -> DataFrame:
    """Trend of every generated segment over the same range at once."""
    return trend.trends(D.history(spark, sf), D.seed_segments(spark, sf),
                        TREND_START, TREND_END)


def segment_trend_json(spark: SparkSession, sf: str) -> DataFrame:
    return trend.trend_json(segment_trend(spark, sf))


def dq_unique_key(spark: SparkSession, sf: str) -> DataFrame:
    """Keys duplicated when a finished run is appended to the crashed day
    instead of replacing it (what the unique key prevents)."""
    appended = D.crash_day(spark, sf).unionByName(metric_daily_rerun(spark, sf))
    return quality.duplicate_keys(appended)


def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(D.accounts(spark, sf))


def segment_touch_updated(spark: SparkSession, sf: str) -> DataFrame:
    """I8/H8: regenerate every definition one ladder step later; rows whose
    text changed get ``updated_at = as_of``, others keep theirs."""
    keys = D.customer_keys(spark, sf)
    old = seed.generate_segments(
        keys.select((F.col("k") + 1).alias("segment_id"),
                    ((F.col("k") * 7) % D.LADDER_STEPS + 1).alias("step")),
        step_col="step", as_of=SEED_AS_OF, domain="nation")
    new = seed.generate_segments(
        keys.select((F.col("k") + 1).alias("segment_id"),
                    ((F.col("k") * 7 + 1) % D.LADDER_STEPS + 1).alias("step")),
        step_col="step", as_of=SEED_AS_OF, domain="nation")
    touched = segments.touch_updated(old, new, dt.datetime(2026, 5, 2, 9, 30))
    return touched.select(
        "segment_id", "changed",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


def _events(spark, sf):
    return D.table(spark, sf, "events").select("event_type", "value")


def latency_summary(spark: SparkSession, sf: str) -> DataFrame:
    return latency.summary(_events(spark, sf), "value", by=["event_type"])


def latency_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return latency.bucket_counts(_events(spark, sf), "value", by=["event_type"])


def latency_bucket_tail(spark: SparkSession, sf: str) -> DataFrame:
    return latency.bucket_tail(latency_buckets(spark, sf), 25)


def latency_histogram_quantile(spark: SparkSession, sf: str) -> DataFrame:
    return latency.histogram_quantile(latency_buckets(spark, sf), by=["event_type"])


def latency_quantile_total(spark: SparkSession, sf: str) -> DataFrame:
    return latency.total_quantile(latency_buckets(spark, sf))


def _null_group(spark, sf):
    """Every fifth event loses its type: a NULL series."""
    e = D.table(spark, sf, "events")
    return e.select(F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"), "value")


def latency_summary_null(spark: SparkSession, sf: str) -> DataFrame:
    return latency.summary(_null_group(spark, sf), "value", by=["event_type"])


def latency_buckets_null(spark: SparkSession, sf: str) -> DataFrame:
    return latency.bucket_counts(_null_group(spark, sf), "value", by=["event_type"])


def segment_page(spark: SparkSession, sf: str) -> DataFrame:
    """One key-set page of the segments, with the total and whether more follow."""
    return segments.segment_page(D.workload_segments(spark, sf), AFTER_SEGMENT, PAGE_SIZE)


def segment_page_end(spark: SparkSession, sf: str) -> DataFrame:
    """The page behind the last segment: the facts without a segment."""
    return segments.segment_page(D.workload_segments(spark, sf), BEHIND_LAST, PAGE_SIZE)


def segment_trends_closed(spark: SparkSession, sf: str) -> DataFrame:
    """I7 + I10: the history stored day by day, all months but the last closed
    into sorted files, then the trend of every generated segment."""
    path = scratch_path(spark)
    tables.write_day(D.history(spark, sf), path)
    tables.close_months_before(spark, path, CLOSE_BEFORE)
    start, end = (dt.date.fromisoformat(x) for x in (TREND_START, TREND_END))
    return trend.trends(tables.read_metrics(spark, path, start, end), D.seed_segments(spark, sf), start, end)


QUERIES = {
    "account_profile": account_profile,
    "segment_parse": segment_parse,
    "segment_normalize": segment_normalize,
    "segment_errors": segment_errors,
    **{k: _single(k) for k in SINGLE_PREDICATES},
    "pred_collation_ci_ai": pred_collation_ci_ai,
    "count_match_all": count_match_all,
    "count_one_segment": count_one_segment,
    "count_all_segments": count_all_segments,
    "count_all_segments_ci": count_all_segments_ci,
    "segment_seed": segment_seed,
    "account_seed": account_seed,
    "metric_backfill": metric_backfill,
    "metric_init_day": metric_init_day,
    "metric_pending_page": metric_pending_page,
    "metric_count_day": metric_count_day,
    "metric_mark_completed": metric_mark_completed,
    "metric_daily_run": metric_daily_run,
    "metric_daily_rerun": metric_daily_rerun,
    "metric_run_errors": metric_run_errors,
    "metric_exists_day": metric_exists_day,
    "segment_trend": segment_trend,
    "segment_trend_json": segment_trend_json,
    "segment_trends": segment_trends,
    "dq_unique_key": dq_unique_key,
    "dq_not_null": dq_not_null,
    "segment_touch_updated": segment_touch_updated,
    "latency_summary": latency_summary,
    "latency_buckets": latency_buckets,
    "latency_bucket_tail": latency_bucket_tail,
    "latency_histogram_quantile": latency_histogram_quantile,
    "latency_quantile_total": latency_quantile_total,
    "latency_summary_null": latency_summary_null,
    "latency_buckets_null": latency_buckets_null,
    "segment_page": segment_page,
    "segment_page_end": segment_page_end,
    "segment_trends_closed": segment_trends_closed,
}
