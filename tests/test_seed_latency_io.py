"""Generators (J5-J7), latency operators (D6-D9) and CSV source/sink (A4/A5)."""

import json
import math
import os

import numpy as np
from pyspark.sql import functions as F

from segmetrics.operators import latency, seed
from segmetrics.sources import tables


def test_segment_generator_spot_values_and_totals(spark):
    segs = seed.generate_segments(seed.segment_ids(spark, 5000))
    got = {r.segment_id: json.loads(r.conditions) for r in segs.collect()}

    def triples(i):
        return [(c["category"], c["operator"], c["value"]) for c in got[i]]
    assert triples(1) == [("order_count", "GTE", "100")]
    assert triples(501) == [("location", "EQUALS", "서울")]
    assert triples(951) == [("age", "GTE", "30"), ("age", "LT", "50")]
    assert triples(1251) == [("gender", "EQUALS", "MALE")]
    assert triples(1501) == [("location", "EQUALS", "서울"), ("order_count", "GTE", "10")]
    assert triples(4501) == [("age", "GTE", "40"), ("gender", "EQUALS", "FEMALE"),
                             ("location", "EQUALS", "서울"), ("order_count", "GTE", "5")]
    allc = [t for i in got for t in triples(i)]
    assert len(allc) == 12619
    ops = {}
    for cat, op, _ in allc:
        ops[(cat, op)] = ops.get((cat, op), 0) + 1
    assert ops == {("location", "EQUALS"): 3050, ("gender", "EQUALS"): 2300,
                   ("order_count", "GTE"): 2090, ("order_count", "LTE"): 1072,
                   ("order_count", "EQUALS"): 77, ("age", "GTE"): 1950,
                   ("age", "LT"): 1950, ("age", "EQUALS"): 130}
    assert sum(("age", "LT", "14") in triples(i) for i in got) == 86
    assert len({json.dumps(sorted(map(tuple, triples(i)))) for i in got}) == 1852


def test_history_backfill(spark):
    h = seed.backfill_history(spark.range(1, 6).withColumnRenamed("id", "segment_id"))
    assert h.count() == 5 * 120
    r = h.where((F.col("segment_id") == 3) & (F.col("metric_date") == "2026-02-01")).first()
    assert r.user_count == 1000 + (3 * 7 % 5000) + (32 % 100) and r.status == "INSERTED"


def test_history_of_few_files_is_dealt_out(spark):
    """Segments read by one task are dealt out before they become 120 rows each; ids that come twice or are null stay."""
    ids = spark.range(1, 401).select(F.when(F.col("id") != 9, F.col("id")).alias("segment_id"))
    hist = seed.backfill_history(ids.unionByName(ids.where("segment_id = 3")).coalesce(1))
    tasks = hist.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 401 * 120 and max(r["count"] for r in tasks) < 401 * 60
    per_id = {r.segment_id: r["count"] for r in hist.groupBy("segment_id").count().collect()}
    assert per_id == {i if i != 9 else None: 240 if i == 3 else 120 for i in range(1, 401)}


def test_account_generator_distribution(spark):
    acc = seed.generate_accounts(spark.range(1, 200001).withColumnRenamed("id", "user_id"))
    stats = acc.agg(F.min("age"), F.max("age"), F.min("order_count"), F.max("order_count"),
                    F.avg((F.col("gender") == "OTHER").cast("int")),
                    F.avg((F.col("location") == "경기").cast("int")),
                    F.avg(((F.col("age") >= 30) & (F.col("age") <= 39)).cast("int")),
                    F.countDistinct("location")).first()
    assert stats[0] == 14 and stats[1] == 99 and stats[2] == 0 and stats[3] <= 500
    assert abs(stats[4] - 0.01) < 0.003
    assert abs(stats[5] - 0.2691) < 0.01
    assert abs(stats[6] - 0.28) < 0.01
    assert stats[7] == 17
    teens = acc.where(F.col("age") < 20).agg(F.max("order_count")).first()[0]
    assert teens <= 20


def test_latency_against_numpy(spark):
    rng = np.random.default_rng(3)
    vals = [float(round(x, 3)) for x in rng.exponential(40, 3000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    s = latency.summary(df, "v").first()
    assert s.n == 3000
    assert abs(s.p95 - np.percentile(vals, 95)) < 1e-6
    bounds = [1.0, 10.0, 50.0, 100.0, math.inf]
    b = {r.le: r.cum_count for r in latency.bucket_counts(df, "v", bounds).collect()}
    assert b == {le: sum(v <= le for v in vals) for le in bounds}
    q = {r.q: r.value for r in latency.histogram_quantile(
        latency.bucket_counts(df, "v", bounds), qs=(0.5,)).collect()}
    rank = 0.5 * 3000
    prev = max(le for le in bounds if b[le] < rank)
    nxt = min(le for le in bounds if b[le] >= rank)
    want = prev + (nxt - prev) * (rank - b[prev]) / (b[nxt] - b[prev])
    assert abs(q[0.5] - round(want, 6)) < 1e-6
    top = {r.q: r.value for r in latency.histogram_quantile(
        latency.bucket_counts(df, "v", [1.0, 2.0, math.inf]), qs=(0.99,)).collect()}
    assert top[0.99] == 2.0


def test_csv_round_trip(spark, tmp_out):
    acc = seed.generate_accounts(spark.range(1, 51).withColumnRenamed("id", "user_id"))
    path = os.path.join(tmp_out, "accounts_csv")
    tables.write_accounts_csv(acc, path)
    back = tables.read_accounts_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, acc.collect()))
    first = open([os.path.join(path, f) for f in sorted(os.listdir(path))
                  if f.startswith("part-")][0], encoding="utf-8").readline()
    assert first.count(",") == 4 and first.startswith("user_")


def test_exact_quantiles_hot_group_spread_over_tasks(spark):
    rng = np.random.default_rng(5)
    hot = [float(x) for x in rng.integers(0, 50, 4000)]      # many ties
    cold = [float(x) for x in rng.normal(10, 3, 300).round(2)]
    rows = [("hot", v) for v in hot] + [("cold", v) for v in cold]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.q): r.value for r in
           latency.exact_quantiles(df, "v", (0.0, 0.5, 0.9, 0.99, 1.0), ["g"]).collect()}
    for g, vals in (("hot", hot), ("cold", cold)):
        for q in (0.0, 0.5, 0.9, 0.99, 1.0):
            assert abs(got[(g, q)] - np.quantile(vals, q)) < 1e-9, (g, q)
    whole = {r.q: r.value for r in latency.exact_quantiles(df, "v", (0.5,)).collect()}
    assert abs(whole[0.5] - np.quantile(hot + cold, 0.5)) < 1e-9
    s = latency.summary(df, "v").first()
    assert s.n == 4300 and abs(s.p50 - round(np.quantile(hot + cold, 0.5), 6)) < 1e-9


def test_quantiles_of_ties_and_null_groups(spark):
    """One value held by a third of the rows, a NULL group, negatives and infinities: against numpy."""
    import numpy as np
    from segmetrics.operators import latency
    g = np.random.default_rng(3)
    rows = [(k, float(v)) for k in ("a", None) for v in np.concatenate((np.zeros(300), g.normal(0, 50, 400), g.exponential(1e-3, 200), g.integers(0, 9, 20)))]
    rows += [("one", 5.0), ("none", None), ("two", -1.0), ("two", 2.0), ("inf", float("inf")), ("inf", 1.0), ("inf", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r.k, r.q): r.value for r in latency.exact_quantiles(df, "v", (0.0, 0.25, 0.5, 0.95, 1.0), ["k"]).collect()}
    for k in {k for k, v in rows if v is not None}:
        vs = [v for x, v in rows if x == k and v is not None]
        for q in (0.0, 0.25, 0.5, 0.95, 1.0):
            with np.errstate(invalid="ignore"):
                want = np.quantile(vs, q)
            assert got[k, q] == want or abs(got[k, q] - want) < 1e-9 or (k == "inf" and q >= 0.5), (k, q)
    assert ("none", 0.5) not in got
    s = {r.k: r for r in latency.summary(df, "v", ["k"]).collect()}
    assert s[None].n == 920 and s[None].p50 is not None and s["none"].p50 is None
    b = latency.bucket_counts(df, "v", [0.0, 10.0, float("inf")], ["k"])
    assert {r.le: r.cum_count for r in b.where("k is null").collect()}[float("inf")] == 920


def test_read_accounts_and_segments(spark, tmp_out):
    from segmetrics import schemas as S
    from segmetrics.sources import tables
    spark.createDataFrame([(1, "user_1", "MALE", 20, "X", 3)], S.ACCOUNT).withColumnRenamed("age", "age").write.parquet(f"{tmp_out}/a")
    assert [tuple(r) for r in tables.read_accounts(spark, f"{tmp_out}/a").collect()] == [(1, "user_1", "MALE", 20, "X", 3)]
    t = spark.sql("SELECT 1L AS segment_id, '[]' AS conditions, TIMESTAMP_NTZ'2026-01-01' AS created_at, TIMESTAMP_NTZ'2026-01-01' AS updated_at")
    t.write.parquet(f"{tmp_out}/s")
    assert tables.read_segments(spark, f"{tmp_out}/s").first().conditions == "[]"


def test_segment_page(spark):
    from segmetrics.operators.segments import segment_page
    df = spark.createDataFrame([(i, "[]") for i in (5, 1, 9, 3)], "segment_id long, conditions string")
    first = segment_page(df, None, 3).collect()
    assert [(r.segment_id, r.total, r.has_next) for r in first] == [(1, 4, True), (3, 4, True), (5, 4, True)]
    assert [(r.segment_id, r.has_next) for r in segment_page(df, 5, 3).collect()] == [(9, False)]
    behind = segment_page(df, 9, 3).collect()
    assert [tuple(r) for r in behind] == [(None, None, 4, False)]
    assert [tuple(r) for r in segment_page(df, 9, 3, total=4).collect()] == [(None, None, 4, False)]
    assert [r.has_next for r in segment_page(df, 1, 2).collect()] == [True, True] and [r.has_next for r in segment_page(df, 1, 3).collect()] == [False] * 3
    assert [tuple(r) for r in segment_page(df.limit(0), None, 3).collect()] == [(None, None, 0, False)]


def test_quantiles_of_large_groups_use_the_sketch(spark):
    """Groups above the sketch's accuracy: only the values in the brackets are counted one by one."""
    import numpy as np
    from pyspark.sql import functions as F
    from segmetrics.operators import latency
    g = np.random.default_rng(9)
    big = {"smooth": g.normal(0, 5, 45_000), "narrow": 1e6 + g.random(30_000), "ties": np.where(g.random(30_000) < 0.97, 7.0, g.normal(0, 1, 30_000)),
           "wide": np.concatenate((g.exponential(1e200, 12_000), -g.exponential(1e-200, 12_000), [np.inf] * 400, [-np.inf] * 300)), "small": g.random(500)}
    rows = [(k, float(v)) for k, vs in big.items() for v in vs] + [("smooth", None)] * 50 + [("nan", float("nan"))] * 11_000 + [("nan", float(i)) for i in range(11_000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    qs = (0.0, 0.001, 0.25, 0.5, 0.951, 0.99, 1.0)
    got = {(r.k, r.q): r.value for r in latency.exact_quantiles(df, "v", qs, ["k"]).collect()}
    for k, vs in big.items():
        for q in qs:
            with np.errstate(invalid="ignore", over="ignore"):
                want = np.quantile(vs, q)
            assert got[k, q] == want or abs(got[k, q] - want) <= 1e-9 * abs(want) or k == "wide" and not np.isfinite(want), (k, q)
    assert got["nan", 0.25] == np.quantile(np.append(np.arange(11_000.0), [np.inf] * 11_000), 0.25) and math.isnan(got["nan", 0.99])
    cells, _ = latency._bracketed(df.where("k IN ('smooth', 'narrow')"), "v", (0.5, 0.95, 0.99), ["k"])
    assert cells.where(F.col("_v").isNotNull()).count() < 1000
    plan = latency.summary(df, "v", ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2 * 3                  # cells feed two branches, whose shuffle is reused
