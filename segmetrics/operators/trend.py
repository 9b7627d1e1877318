"""Trend of a segment's size between two dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_day(text: str) -> dt.date:
    """Strict ISO ``yyyy-MM-dd``; bad input is rejected before running."""
    if not isinstance(text, str) or len(text) != 10:
        raise ValueError(f"not an ISO date: {text!r}")
    return dt.date.fromisoformat(text)


def trend(metrics: DataFrame, segment_id: int, start, end) -> DataFrame:
    """(date, count) of one segment, inclusive range, oldest first, any status
    (a PENDING day shows its 0), gaps not filled; reversed range -> no rows.
    The date filter prunes ``metric_date`` partitions of a stored table and the
    id filter is pushed to the parquet scan."""
    start = parse_day(start) if isinstance(start, str) else start
    end = parse_day(end) if isinstance(end, str) else end
    return (metrics.where((F.col("segment_id") == F.lit(segment_id))
                          & F.col("metric_date").between(F.lit(start), F.lit(end)))
            .select(F.col("metric_date").alias("date"),
                    F.col("user_count").alias("count"))
            .orderBy("date"))


def trends(metrics: DataFrame, segment_ids: DataFrame, start, end) -> DataFrame:
    """Trend for many segments at once: a semi join on the requested ids
    (shuffle by segment id), then a sort within each segment."""
    start = parse_day(start) if isinstance(start, str) else start
    end = parse_day(end) if isinstance(end, str) else end
    return (metrics.where(F.col("metric_date").between(F.lit(start), F.lit(end)))
            .join(segment_ids.select("segment_id"), "segment_id", "left_semi")
            .select("segment_id", F.col("metric_date").alias("date"),
                    F.col("user_count").alias("count"))
            .repartition("segment_id").sortWithinPartitions("segment_id", "date"))


def trend_json(trend_rows: DataFrame) -> DataFrame:
    """One JSON object per row, ISO date text, e.g.
    ``{"date":"2026-01-01","count":500}``."""
    return trend_rows.select(F.to_json(F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("count").alias("count"))).alias("json"))
