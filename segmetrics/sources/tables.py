"""Sources and sinks.

* ``read_accounts`` / ``read_segments`` / ``read_metrics`` -- parquet tables
  with fixed schemas (no inference); the metric table is partitioned by
  ``metric_date`` so date filters prune directories.
* ``read_accounts_jdbc`` -- the same table from a database, split on
  ``user_id`` ranges across tasks (needs a reachable database and driver).
* ``read_accounts_csv`` / ``write_accounts_csv`` -- the seed CSV layout (no
  header; name, gender, age, location, order_count); ``user_id`` comes from
  the ``user_{n}`` name, not from arrival order.
* ``write_day`` -- replaces the day partitions present in the frame and
  nothing else (dynamic partition overwrite set on the write itself; the
  default static mode would first delete the whole table). A stored row holds
  count, status and reason: ``read_metrics`` and ``read_errors`` are two views
  of one commit.
* ``close_month`` -- a finished month as one partition of sorted files.
* ``write_trend_json`` -- trend rows as JSON lines with ISO dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..session import materialize

# Sort order of the files of a day and of a closed month; the first column is the partition.
DAY_ORDER, MONTH_ORDER = ["metric_date", "segment_id"], ["month", "segment_id", "metric_date"]


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.ACCOUNT).parquet(path)


def read_accounts_jdbc(spark: SparkSession, url: str, lower: int, upper: int,
                       table: str = "account", partitions: int = 64, **props) -> DataFrame:
    """``lower`` and ``upper``: least and largest ``user_id`` of the table. They
    have no default: rows beyond them would all be read by the outer tasks."""
    return spark.read.jdbc(url, table, column="user_id", lowerBound=lower,
                           upperBound=upper, numPartitions=partitions,
                           properties=props)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.SEGMENT).parquet(path)


def _folder(spark: SparkSession, path: str):
    """Hadoop path and file system of a folder (any store that Spark reads)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders below ``path`` (none if it is not there)."""
    at, fs = _folder(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory()] if fs.exists(at) else []
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{column}="))


def _closed(path: str) -> str:
    return f"{path.rstrip('/')}.closed"


def closed_months(spark: SparkSession, path: str) -> list[str]:
    """``yyyy-MM`` of the months of a metric table that are stored as one sorted partition."""
    return _partitions(spark, _closed(path), "month")


def read_days(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Every stored row, ``segment_id, metric_date, user_count, status,
    error_reason``: open days and closed months. A closed month counts alone,
    so day folders that a broken ``close_month`` left behind are not read.
    ``start`` / ``end`` (inclusive dates) prune days and months."""
    closed = closed_months(spark, path)
    parts = []
    if not closed or _partitions(spark, path, "metric_date"):
        days = spark.read.schema(S.STORED_DAY).parquet(path)
        if closed:
            days = days.where(~F.date_format("metric_date", "yyyy-MM").isin(closed))
        parts.append(days)
    if closed:
        months = spark.read.schema(S.STORED_MONTH).parquet(_closed(path))
        if start is not None:
            months = months.where(F.col("month") >= F.lit(f"{start:%Y-%m}"))
        if end is not None:
            months = months.where(F.col("month") <= F.lit(f"{end:%Y-%m}"))
        parts.append(months)
    out = None
    for part in parts:
        if start is not None:
            part = part.where(F.col("metric_date") >= F.lit(start))
        if end is not None:
            part = part.where(F.col("metric_date") <= F.lit(end))
        part = part.select("segment_id", "metric_date", "user_count", "status", "error_reason")
        out = part if out is None else out.unionByName(part)
    return out


def read_metrics(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """A3: the counts of the stored rows (``read_days`` without the reasons)."""
    return read_days(spark, path, start, end).select(*S.METRIC.fieldNames())


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(S.ACCOUNT_CSV).csv(path, header=False)
    uid = F.regexp_extract("name", r"^user_(\d+)$", 1)
    return raw.select(F.when(uid != "", uid).cast("long").alias("user_id"),
                      "name", "gender", "age", "location", "order_count")


def write_accounts_csv(accounts: DataFrame, path: str, mode: str = "overwrite") -> None:
    (accounts.select("name", "gender", "age", "location", "order_count")
     .write.mode(mode).csv(path, header=False))


def write_day(rows: DataFrame, path: str, rows_per_file: int = 2_000_000) -> dict[str, int]:
    """Write the days' final rows, counts and reasons in one commit.
    They must not be read from the partition that they replace
    (``execute_daily_batch`` checkpoints them). Each task gets a contiguous,
    sorted ``segment_id`` range (AQE sizes the tasks), so files stay bounded and
    a lookup of one segment skips row groups by their min/max statistics. Only
    the days present in ``rows`` are replaced (dynamic partition overwrite); a
    day of a closed month is replaced inside that month.

    Returns ``rows`` and ``errors``, counted by the write itself (``observe``)."""
    if "error_reason" not in rows.columns:
        rows = rows.withColumn("error_reason", F.lit(None).cast("string"))
    rows = rows.select("segment_id", "metric_date", "user_count", "status", "error_reason")
    spark, counts = rows.sparkSession, {"rows": 0, "errors": 0}
    month = F.date_format("metric_date", "yyyy-MM")
    closed = closed_months(spark, path)
    late = [r.metric_date for r in rows.where(month.isin(closed)).select("metric_date").distinct().collect()] if closed else []
    if late:
        new = rows.where(F.col("metric_date").isin(late))
        months = sorted({f"{d:%Y-%m}" for d in late})
        old = (spark.read.schema(S.STORED_MONTH).parquet(_closed(path))
               .where(F.col("month").isin(months) & ~F.col("metric_date").isin(late)).drop("month"))
        both = materialize(old.unionByName(new))             # it replaces what it reads
        _add(counts, _write_months(both, path, rows_per_file, F.col("metric_date").isin(late)))
        rows = rows.where(~F.col("metric_date").isin(late))
    _add(counts, _write(rows.repartitionByRange(*DAY_ORDER), path, DAY_ORDER, rows_per_file, F.lit(True)))
    return counts


def _add(counts: dict[str, int], more: dict[str, int]) -> None:
    for k in counts:
        counts[k] += more[k] or 0


def _write(dealt: DataFrame, path: str, order: list[str], rows_per_file: int, counted) -> dict[str, int]:
    seen = Observation()
    (dealt.sortWithinPartitions(*order)
     .observe(seen, F.count_if(counted).alias("rows"), F.count_if(counted & F.col("error_reason").isNotNull()).alias("errors"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
     .partitionBy(order[0]).parquet(path))
    return seen.get


def _write_months(rows: DataFrame, path: str, rows_per_file: int, counted) -> dict[str, int]:
    rows = rows.withColumn("month", F.date_format("metric_date", "yyyy-MM"))
    return _write(rows.repartitionByRange(*MONTH_ORDER), _closed(path), MONTH_ORDER, rows_per_file, counted)


def _deal_month(rows: DataFrame, month: str) -> DataFrame:
    """Rows that are all of ``month``, dealt out without it: its text is not
    formatted, sampled or shuffled row by row. It is no plain literal: Spark
    drops a constant from the sort and adds another sort by ``month`` behind it,
    which may undo the order of the first when it spills."""
    return (rows.repartitionByRange(*MONTH_ORDER[1:])
            .withColumn("month", F.when(F.col("metric_date").isNotNull(), F.lit(month))))


def close_month(spark: SparkSession, path: str, month: str, rows_per_file: int = 2_000_000) -> None:
    """Turn the day folders of ``month`` (``yyyy-MM``) into one partition
    of files sorted by segment and day, then delete them. A long history is so
    a few files a month, and a segment's trend reads a few row groups of each.
    The partition is committed first and then counts alone: a run that breaks
    in between is finished by the next call. A month without days stays open."""
    days = [d for d in _partitions(spark, path, "metric_date") if d.startswith(f"{month}-")]
    if month not in closed_months(spark, path) and days:
        folders = [f"{path.rstrip('/')}/metric_date={d}" for d in days]          # no other day is listed
        rows = spark.read.schema(S.STORED_DAY).option("basePath", path).parquet(*folders)
        _write(_deal_month(rows, month), _closed(path), MONTH_ORDER, rows_per_file, F.lit(True))
    for d in days:
        at, fs = _folder(spark, f"{path.rstrip('/')}/metric_date={d}")
        fs.delete(at, True)


def close_months_before(spark: SparkSession, path: str, day) -> list[str]:
    """Close every month before that of ``day`` that still has day folders."""
    months = sorted({d[:7] for d in _partitions(spark, path, "metric_date") if d[:7] < f"{day:%Y-%m}"})
    for month in months:
        close_month(spark, path, month)
    return months


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """The stored reasons of segments that could not be counted."""
    return read_days(spark, path).where(F.col("error_reason").isNotNull()).select("segment_id", "error_reason", "metric_date")


def write_trend_json(trend_rows: DataFrame, path: str) -> None:
    (trend_rows.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "count")
     .write.mode("overwrite").json(path))
