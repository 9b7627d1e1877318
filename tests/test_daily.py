"""Daily run states (FIXTURES.md section 5), sink and trend."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from segmetrics import schemas as S
from segmetrics.operators import daily, trend
from segmetrics.sources import tables

DAY = dt.date(2026, 5, 1)
ACC = [(1, "a", "MALE", 20, "NATION_1", 0), (2, "b", "FEMALE", 35, "NATION_2", 5),
       (3, "c", "MALE", 40, "NATION_1", 9)]
ACC_SCHEMA = "user_id long, name string, gender string, age int, location string, order_count int"


def seg_df(spark, rows):
    return spark.createDataFrame(
        [(i, None if c is None else json.dumps(c)) for i, c in rows],
        "segment_id long, conditions string")


def metric_df(spark, rows):
    return spark.createDataFrame(rows, S.METRIC)


def as_dict(df):
    return {r.segment_id: (r.user_count, r.status) for r in df.collect()}


@pytest.fixture
def setup(spark):
    acc = spark.createDataFrame(ACC, ACC_SCHEMA)
    segs = seg_df(spark, [
        (1, [{"category": "gender", "operator": "EQUALS", "value": "MALE"}]),
        (2, None),
        (3, [{"category": "gender", "operator": "GT", "value": "MALE"}]),
        (4, [{"category": "age", "operator": "LT", "value": "14"}]),
    ])
    return acc, segs


def test_first_run(spark, setup):
    acc, segs = setup
    rows, errors = daily.run_day(metric_df(spark, []), segs, acc, DAY)
    assert as_dict(rows) == {1: (2, "INSERTED"), 2: (3, "INSERTED"), 3: (0, "PENDING"),
                             4: (0, "INSERTED")}
    assert {(r.segment_id, r.error_reason) for r in errors.collect()} == \
        {(3, S.UNSUPPORTED_OPERATOR)}


def test_rerun_of_finished_day_is_noop(spark, setup):
    acc, segs = setup
    done = [(1, DAY, 7, "INSERTED"), (2, DAY, 8, "INSERTED"), (3, DAY, 0, "INSERTED"),
            (4, DAY, 9, "INSERTED")]
    rows, errors = daily.run_day(metric_df(spark, done), segs, acc, DAY)
    assert as_dict(rows) == {1: (7, "INSERTED"), 2: (8, "INSERTED"), 3: (0, "INSERTED"),
                             4: (9, "INSERTED")}
    assert errors.count() == 0


def test_crash_recovery_and_missing_segment(spark, setup):
    acc, segs = setup
    other_day = dt.date(2026, 4, 30)
    state = [(1, DAY, 55, "COUNTED"),      # promoted without recount
             (2, DAY, 0, "PENDING"),       # counted now
             (9, DAY, 0, "PENDING"),       # segment deleted
             (1, other_day, 1, "INSERTED")]
    rows, errors = daily.run_day(metric_df(spark, state), segs, acc, DAY)
    assert as_dict(rows) == {1: (55, "INSERTED"), 2: (3, "INSERTED"), 3: (0, "PENDING"),
                             4: (0, "INSERTED"), 9: (0, "PENDING")}
    assert {(r.segment_id, r.error_reason) for r in errors.collect()} == \
        {(3, S.UNSUPPORTED_OPERATOR), (9, S.SEGMENT_MISSING)}
    assert rows.where(F.col("metric_date") != F.lit(DAY)).count() == 0


def test_pending_page(spark, setup):
    _, segs = setup
    rows = daily.init_day(metric_df(spark, []), segs, DAY)
    assert [r.segment_id for r in daily.pending_page(rows, DAY, 1, 2).collect()] == [3, 4]


def test_write_day_replaces_only_that_day_and_prunes(spark, setup, tmp_out):
    acc, segs = setup
    path = os.path.join(tmp_out, "metrics")
    old = [(1, dt.date(2026, 4, 30), 11, "INSERTED"), (2, dt.date(2026, 4, 30), 12, "INSERTED"),
           (1, DAY, 0, "PENDING")]
    metric_df(spark, old).write.partitionBy("metric_date").parquet(path)
    stored = tables.read_metrics(spark, path)
    rows, _ = daily.run_day(stored, segs, acc, DAY)
    tables.write_day(rows, path)
    after = tables.read_metrics(spark, path)
    assert as_dict(after.where(F.col("metric_date") == F.lit(dt.date(2026, 4, 30)))) == \
        {1: (11, "INSERTED"), 2: (12, "INSERTED")}
    first_day = as_dict(after.where(F.col("metric_date") == F.lit(DAY)))
    assert first_day[1] == (2, "INSERTED")
    # re-running the finished day changes nothing
    rows2, _ = daily.run_day(tables.read_metrics(spark, path), segs, acc, DAY)
    tables.write_day(rows2, path)
    assert as_dict(tables.read_metrics(spark, path).where(F.col("metric_date") == F.lit(DAY))) \
        == first_day
    plan = trend.trend(tables.read_metrics(spark, path), 1, "2026-04-30", "2026-04-30") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metric_date" in plan
    assert "PushedFilters: [IsNotNull(segment_id), EqualTo(segment_id,1)]" in plan


def test_trend_rules(spark):
    m = metric_df(spark, [(1, dt.date(2026, 1, 3), 30, "INSERTED"),
                          (1, dt.date(2026, 1, 1), 10, "INSERTED"),
                          (1, dt.date(2026, 1, 2), 0, "PENDING"),
                          (2, dt.date(2026, 1, 2), 99, "INSERTED")])
    got = [(r.date.isoformat(), r["count"]) for r in
           trend.trend(m, 1, "2026-01-01", "2026-01-03").collect()]
    assert got == [("2026-01-01", 10), ("2026-01-02", 0), ("2026-01-03", 30)]
    assert trend.trend(m, 1, "2026-01-03", "2026-01-01").count() == 0
    assert trend.trend(m, 7, "2026-01-01", "2026-01-03").count() == 0
    js = [r.json for r in trend.trend_json(trend.trend(m, 1, "2026-01-01", "2026-01-01")).collect()]
    assert js == ['{"date":"2026-01-01","count":10}']
    with pytest.raises(ValueError):
        trend.parse_day("2026-1-01")


def test_execute_daily_batch_and_run_metrics(spark, setup, tmp_out):
    from segmetrics.operators import latency
    acc, segs = setup
    path, stored = os.path.join(tmp_out, "m"), os.path.join(tmp_out, "r")
    for run in ("r1", "r2"):
        rm = daily.execute_daily_batch(spark, acc, segs, path, DAY, run_id=run, run_metrics_path=stored)
        assert {r.stage for r in rm.collect()} == {"init_step", "count_step", "flush", "total"}
        assert {r.errors for r in rm.collect()} == {1}
    assert spark.read.parquet(stored).count() == 8
    assert as_dict(tables.read_metrics(spark, path))[1] == (2, "INSERTED")
    errs = tables.read_errors(spark, path).collect()
    assert [(r.segment_id, r.error_reason) for r in errs] == [(3, S.UNSUPPORTED_OPERATOR)]
    assert latency.summary(rm, "seconds").first().n == 4


def test_repaired_definition_leaves_no_error(spark, setup, tmp_out):
    acc, segs = setup
    path = os.path.join(tmp_out, "m")
    other = dt.date(2026, 4, 30)
    for day in (other, DAY):
        daily.execute_daily_batch(spark, acc, segs, path, day)
    assert {(r.metric_date, r.segment_id) for r in tables.read_errors(spark, path).collect()} == {(other, 3), (DAY, 3)}
    repaired = segs.where("segment_id <> 3").unionByName(
        seg_df(spark, [(3, [{"category": "gender", "operator": "EQUALS", "value": "FEMALE"}])]))
    daily.execute_daily_batch(spark, acc, repaired, path, DAY)
    assert as_dict(tables.read_metrics(spark, path).where(F.col("metric_date") == F.lit(DAY)))[3] == (1, "INSERTED")
    assert {(r.metric_date, r.segment_id) for r in tables.read_errors(spark, path).collect()} == {(other, 3)}


def test_daily_run_deletes_its_checkpoints(spark, setup, tmp_out):
    acc, segs = setup
    root = spark.conf.get("spark.checkpoint.dir")
    before = {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs}
    daily.execute_daily_batch(spark, acc, segs, os.path.join(tmp_out, "m"), DAY)
    assert {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs} == before
    assert not [d for d in os.listdir(root) if d.startswith("run-")]
    assert daily.run_day(metric_df(spark, []), segs, acc, DAY)[0].count() == 4        # later checkpoints work


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from segmetrics.session import checkpoint_root, cluster_conf
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            checkpoint_root(None, master)
        assert checkpoint_root("hdfs:///c", master) == "hdfs:///c"
    assert os.path.isdir(checkpoint_root(None, "local[4]"))
    assert cluster_conf(10, "hdfs:///c")["spark.checkpoint.dir"] == "hdfs:///c"


def test_today_is_the_zone_of_the_schedule():
    from zoneinfo import ZoneInfo
    for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago"):
        assert daily.today(zone) == dt.datetime.now(ZoneInfo(zone)).date()
    assert daily.today() == dt.datetime.now(ZoneInfo("Asia/Seoul")).date()


def test_daily_job_main(spark, setup, tmp_out):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
    import daily_job
    acc, segs = setup
    at = {n: os.path.join(tmp_out, n) for n in ("accounts", "segments", "metrics", "runs")}
    acc.write.parquet(at["accounts"])
    t = F.lit("2026-05-01 00:00:00").cast("timestamp_ntz")
    segs.select("segment_id", "conditions", t.alias("created_at"), t.alias("updated_at")).write.parquet(at["segments"])
    daily_job.main(["--accounts", at["accounts"], "--segments", at["segments"], "--metrics", at["metrics"],
                    "--run-metrics", at["runs"], "--day", "2026-05-01", "--close-months"])
    assert as_dict(tables.read_metrics(spark, at["metrics"]))[1] == (2, "INSERTED")
    assert tables.read_errors(spark, at["metrics"]).count() == 1 and spark.read.parquet(at["runs"]).count() == 4


def test_trend_json_file(spark, tmp_out):
    path = os.path.join(tmp_out, "j")
    m = metric_df(spark, [(1, dt.date(2026, 1, 1), 10, "INSERTED"), (1, dt.date(2026, 1, 2), 5, "PENDING")])
    tables.write_trend_json(trend.trend(m, 1, "2026-01-01", "2026-01-03"), path)
    assert sorted((r.date, r["count"]) for r in spark.read.schema("date string, count long").json(path).collect()) == \
        [("2026-01-01", 10), ("2026-01-02", 5)]


def test_write_day_bounded_sorted_files(spark, tmp_out):
    import pyarrow.parquet as pq
    path = os.path.join(tmp_out, "sorted")
    rows = metric_df(spark, [(i, DAY, i * 10, "INSERTED") for i in (7, 3, 9, 1, 5, 8, 2)])
    tables.write_day(rows, path, rows_per_file=3)
    day_dir = os.path.join(path, f"metric_date={DAY.isoformat()}")
    files = sorted(f for f in os.listdir(day_dir) if f.endswith(".parquet"))
    assert len(files) >= 3
    ranges = []
    for f in files:
        ids = pq.read_table(os.path.join(day_dir, f)).column("segment_id").to_pylist()
        assert ids == sorted(ids) and len(ids) <= 3
        ranges.append((ids[0], ids[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert sorted(r.segment_id for r in tables.read_metrics(spark, path).collect()) == \
        [1, 2, 3, 5, 7, 8, 9]


def stored_day(spark, path, day):
    return sorted(map(tuple, tables.read_days(spark, path, day, day).select("segment_id", "user_count", "status", "error_reason").collect()))


def test_broken_write_leaves_the_old_day(spark, setup, tmp_out):
    """Counts and reasons change in one commit: a run that breaks while it writes shows the old day in both views."""
    acc, segs = setup
    path = os.path.join(tmp_out, "m")
    daily.execute_daily_batch(spark, acc, segs, path, DAY)
    before = stored_day(spark, path, DAY)
    assert (3, 0, "PENDING", S.UNSUPPORTED_OPERATOR) in before
    from segmetrics.session import materialize
    rows = materialize(tables.read_days(spark, path)).select("segment_id", "metric_date", F.lit(77).cast("long").alias("user_count"), "status",
                                                             F.when(F.col("segment_id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.lit("other")).alias("error_reason"))
    with pytest.raises(Exception, match="lost"):
        tables.write_day(rows, path)
    assert stored_day(spark, path, DAY) == before
    counts = tables.write_day(materialize(tables.read_days(spark, path).withColumn("error_reason", F.lit("other"))), path)
    assert counts == {"rows": len(before), "errors": len(before)}
    assert {r.error_reason for r in tables.read_errors(spark, path).collect()} == {"other"}


def test_closed_months_are_few_sorted_files(spark, tmp_out):
    """120 days, closed months: 4 files and the open days, months pruned, late days replaced inside their month."""
    path = os.path.join(tmp_out, "m")
    first = dt.date(2026, 1, 1)
    rows = [(i, first + dt.timedelta(d), 1000 * i + d, "INSERTED") for i in range(1, 41) for d in range(120)]
    tables.write_day(metric_df(spark, rows).repartition(5), path)
    want = {(r[0], r[1]): r[2] for r in rows}

    def read(*between):
        return {(r.segment_id, r.metric_date): r.user_count for r in tables.read_metrics(spark, path, *between).collect()}
    assert read() == want and len(tables.read_metrics(spark, path).inputFiles()) == 120
    assert tables.close_months_before(spark, path, dt.date(2026, 4, 30)) == ["2026-01", "2026-02", "2026-03"]
    assert tables.closed_months(spark, path) == ["2026-01", "2026-02", "2026-03"] and read() == want
    assert len(tables.read_metrics(spark, path).inputFiles()) == 3 + 30
    tables.close_month(spark, path, "2026-04")
    tables.close_month(spark, path, "2026-04")                                    # nothing left to do
    files = tables.read_metrics(spark, path).inputFiles()
    assert len(files) == 4 and read() == want
    import pyarrow.parquet as pq
    keys = [(r["segment_id"], r["metric_date"]) for r in pq.read_table(files[0].removeprefix("file://"), partitioning=None).select(["segment_id", "metric_date"]).to_pylist()]
    assert keys == sorted(keys)
    between = dt.date(2026, 2, 3), dt.date(2026, 3, 5)
    assert read(*between) == {k: v for k, v in want.items() if between[0] <= k[1] <= between[1]}
    plan = trend.trend(tables.read_metrics(spark, path, *between), 7, *between)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "IsNotNull(segment_id)" in plan
    # a late day of a closed month, and a new one
    late = [(i, first + dt.timedelta(40), 5, "INSERTED") for i in range(1, 45)] + [(1, dt.date(2026, 5, 1), 9, "PENDING")]
    assert tables.write_day(metric_df(spark, late), path) == {"rows": 45, "errors": 0}
    want = {k: v for k, v in want.items() if k[1] != late[0][1]} | {(r[0], r[1]): r[2] for r in late}
    assert read() == want and len(tables.read_metrics(spark, path).inputFiles()) == 5
    # day folders that a broken close left behind are not read, and go with the next call
    metric_df(spark, [(1, first, -1, "PENDING")]).write.mode("append").partitionBy("metric_date").parquet(path)
    assert read() == want
    tables.close_month(spark, path, "2026-01")
    assert read() == want and sorted(d for d in os.listdir(path) if d.startswith("metric_date")) == ["metric_date=2026-05-01"]
    assert stored_day(spark, path, dt.date(2030, 1, 1)) == []


def test_daily_run_into_a_closed_month(spark, setup, tmp_out):
    acc, segs = setup
    path = os.path.join(tmp_out, "m")
    daily.execute_daily_batch(spark, acc, segs, path, DAY)
    tables.close_month(spark, path, f"{DAY:%Y-%m}")
    other = DAY + dt.timedelta(1)
    rm = daily.execute_daily_batch(spark, acc, segs, path, other)
    assert {r.errors for r in rm.collect()} == {1}
    assert stored_day(spark, path, other) == stored_day(spark, path, DAY)
    assert {(r.metric_date, r.segment_id) for r in tables.read_errors(spark, path).collect()} == {(DAY, 3), (other, 3)}


def test_a_month_is_closed_by_one_sort_without_its_text_in_the_shuffle(spark, tmp_out):
    """Rows that come twice, null ids and reasons stay; the month is put on behind the shuffle, and one sort is enough."""
    path = os.path.join(tmp_out, "m")
    days = [dt.date(2026, 1, 30), dt.date(2026, 1, 31), dt.date(2026, 2, 1)]
    rows = [(i, d, 10 * (i or 0), "PENDING", None if (i or 0) % 2 else "bad") for i in (*range(60, 0, -1), 7, None) for d in days]
    schema = "segment_id long, metric_date date, user_count long, status string, error_reason string"
    tables.write_day(spark.createDataFrame(rows, schema), path)
    plan = tables._deal_month(tables.read_days(spark, path), "2026-01").sortWithinPartitions(*tables.MONTH_ORDER)._jdf.queryExecution().executedPlan().toString()
    exchange, = (x for x in plan.splitlines() if "Exchange" in x)
    assert "month" not in exchange and "segment_id" in exchange and "Sort [month" in plan
    tables.close_month(spark, path, "2026-01", rows_per_file=50)
    key = lambda r: tuple((v is not None, v) for v in r)                            # noqa: E731
    assert sorted(map(tuple, tables.read_days(spark, path).collect()), key=key) == sorted(rows, key=key)
    assert sorted(x for x in os.listdir(path) if x.startswith("metric_date")) == ["metric_date=2026-02-01"]
    import pyarrow.parquet as pq
    folder = os.path.join(f"{path}.closed", "month=2026-01")
    files = [pq.read_table(os.path.join(folder, f), partitioning=None).select(["segment_id", "metric_date"]).to_pylist() for f in os.listdir(folder) if f.endswith(".parquet")]
    keys = sorted(([(r["segment_id"] or 0, r["metric_date"]) for r in f] for f in files), key=lambda f: (f[0], f[-1]))
    assert len(keys) >= 3 and sum(map(len, keys)) == 124 and all(len(f) <= 50 for f in keys)
    assert sum(keys, []) == sorted(sum(keys, []))
