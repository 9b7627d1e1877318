"""Segment upsert (I8), quality checks (D3-D5, B24) and multi-segment trend."""

import datetime as dt

from segmetrics import schemas as S
from segmetrics.operators import quality, segments, trend

AS_OF = dt.datetime(2026, 5, 2, 9, 30)


def test_touch_updated(spark):
    t0 = dt.datetime(2026, 1, 1, 0, 0)
    old = spark.createDataFrame(
        [(1, "[]", t0, t0), (2, "[1]", t0, t0), (3, None, t0, t0)], S.SEGMENT)
    new = spark.createDataFrame(
        [(1, "[]", t0, t0), (2, "[2]", t0, t0), (4, "[]", t0, t0)], S.SEGMENT)
    got = {r.segment_id: (r.conditions, r.created_at, r.updated_at, r.changed)
           for r in segments.touch_updated(old, new, AS_OF).collect()}
    assert got[1] == ("[]", t0, t0, False)           # unchanged keeps timestamps
    assert got[2] == ("[2]", t0, AS_OF, True)        # changed: updated_at touched
    assert got[3] == (None, t0, t0, False)           # only in old: kept
    assert got[4] == ("[]", AS_OF, AS_OF, True)      # new id inserted


def test_quality_checks(spark):
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    m = spark.createDataFrame([(1, d1, 5, "INSERTED"), (1, d1, 6, "INSERTED"),
                               (2, d1, 7, "PENDING"), (1, d2, 8, "INSERTED")], S.METRIC)
    dups = [(r.segment_id, r.metric_date, r.n) for r in quality.duplicate_keys(m).collect()]
    assert dups == [(1, d1, 2)]
    pres = {r.metric_date: (r.n_rows, r.has_rows)
            for r in quality.day_presence(spark, m, [d1, dt.date(2026, 3, 3)]).collect()}
    assert pres == {d1: (3, True), dt.date(2026, 3, 3): (0, False)}
    acc = spark.createDataFrame([(1, None, "MALE"), (2, "b", None), (3, None, None)],
                                "user_id long, name string, gender string")
    nulls = {r.column_name: r.null_count for r in quality.null_counts(acc).collect()}
    assert nulls == {"user_id": 0, "name": 2, "gender": 2}


def test_trends_for_many_segments(spark):
    d = [dt.date(2026, 1, i) for i in (1, 2, 3)]
    m = spark.createDataFrame([(1, d[1], 20, "INSERTED"), (1, d[0], 10, "INSERTED"),
                               (2, d[2], 30, "PENDING"), (3, d[0], 40, "INSERTED")], S.METRIC)
    ids = spark.createDataFrame([(1,), (2,), (9,)], "segment_id long")
    got = [(r.segment_id, r.date, r["count"]) for r in
           trend.trends(m, ids, "2026-01-01", "2026-01-03").collect()]
    assert sorted(got) == [(1, d[0], 10), (1, d[1], 20), (2, d[2], 30)]
    by_seg = {}
    for sid, day, _ in got:                       # sorted within each segment
        by_seg.setdefault(sid, []).append(day)
    assert all(v == sorted(v) for v in by_seg.values())
