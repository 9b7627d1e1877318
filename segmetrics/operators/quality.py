"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys=("segment_id", "metric_date")) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """One row per column with its number of nulls, from a single pass
    (one global aggregate, then a stack of the columns into rows)."""
    columns = list(columns or df.columns)
    sums = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c)
                    for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return sums.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)") \
        .select("column_name", F.coalesce("null_count", F.lit(0)).alias("null_count"))


def day_presence(spark: SparkSession, metrics: DataFrame, days) -> DataFrame:
    """For each probed day, whether any row exists and how many.
    The probe list is a handful of literal dates; the counts are one
    aggregate over the metric table (partition pruned to those days)."""
    probes = spark.createDataFrame([(d,) for d in days], "metric_date date")
    counts = (metrics.where(F.col("metric_date").isin(list(days)))
              .groupBy("metric_date").agg(F.count(F.lit(1)).alias("n_rows")))
    return (probes.join(counts, "metric_date", "left")
            .select("metric_date",
                    F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
                    (F.coalesce("n_rows", F.lit(0)) > 0).alias("has_rows")))
