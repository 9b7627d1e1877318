"""Test-data synthesis as Spark jobs.

* ``segment_conditions(n)`` -- the segment generator: a JSON condition list for
  ladder step ``n``, reproduced exactly with integer arithmetic (L1-L4, J6).
* ``generate_segments(ids)`` -- one segment row per id (J6).
* ``generate_accounts(ids)`` -- accounts whose columns follow the seed
  distributions, drawn from the id with integer hashing (J1-J5).  The draws are
  deterministic per id, so any partitioning and any retry gives the same rows.
* ``backfill_history(segments)`` -- 120 days of INSERTED metric rows (J7),
  one ``explode(sequence(...))`` per segment instead of a cross join.

Everything is a column expression over the input ids: no driver loop, no
Python UDF, and the work is split by however the input is partitioned.
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

# ---------------------------------------------------------------------------
# Fixed values of the segment generator (must equal the reference's).
# ---------------------------------------------------------------------------
GENDER_MULT, LOCATION_MULT, AGE_MULT, ORDER_MULT = (
    668265263, 2654435761, 2246822519, 3266489917)

# Location by r = (n * 2654435761) MOD 1000: value used while r < bound.
LOCATION_LADDER = [
    (300, "서울"), (550, "경기"), (670, "부산"), (740, "인천"), (790, "대구"),
    (830, "대전"), (860, "광주"), (885, "울산"), (905, "충남"), (923, "충북"),
    (940, "경남"), (955, "경북"), (968, "전북"), (980, "전남"), (990, "강원"),
    (997, "제주"), (1000, "세종"),
]

# Age: op_choice = r MOD 100 with r = n * 2246822519.
AGE_EQUALS_VALUES = ["16", "18", "19", "60"]                 # op_choice < 5
AGE_GTE_VALUES = ["20", "25", "30", "40", "50", "55", "60", "65"]  # < 25
AGE_LT_VALUES = ["14", "19", "20", "30", "40", "50"]          # < 45
AGE_RANGE_PICK = [1, 1, 2, 2, 3, 3, 3, 4, 4, 5, 5, 5, 5, 6, 6, 6, 6, 7, 7, 8, 8, 9]
AGE_RANGE_GTE = ["14", "19", "20", "20", "30", "30", "40", "50", "60"]
AGE_RANGE_LT = ["20", "25", "30", "35", "40", "50", "60", "70", "100"]

# Order count: op_choice = r MOD 100 with r = n * 3266489917.
ORDER_EQUALS_VALUES = ["0", "0", "0", "1"]                      # op_choice < 3
ORDER_GTE_VALUES = ["5", "10", "20", "30", "50", "100", "200"]  # < 58
ORDER_LTE_VALUES = ["0", "1", "3", "5", "10"]                   # < 73
ORDER_RANGE_PICK = [1, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 5, 5, 5, 5, 6, 6, 6, 7, 7, 7]
ORDER_RANGE_GTE = ["1", "2", "6", "11", "21", "51", "101"]
ORDER_RANGE_LTE = ["5", "5", "20", "30", "50", "100", "200"]

# Segment id ladder: (last n, generators in merge order).
SEGMENT_LADDER = [
    (500, ["order_count"]),
    (950, ["location"]),
    (1250, ["age"]),
    (1500, ["gender"]),
    (2100, ["location", "order_count"]),
    (2550, ["age", "gender"]),
    (2900, ["age", "location"]),
    (3200, ["gender", "location"]),
    (3400, ["age", "order_count"]),
    (3500, ["gender", "order_count"]),
    (3850, ["age", "gender", "location"]),
    (4150, ["age", "location", "order_count"]),
    (4350, ["gender", "location", "order_count"]),
    (4500, ["age", "gender", "order_count"]),
    (None, ["age", "gender", "location", "order_count"]),
]

HISTORY_START, HISTORY_END = dt.date(2026, 1, 1), dt.date(2026, 4, 30)

# ---------------------------------------------------------------------------
# Fixed values of the account distributions (weights as in the seed script,
# scaled to integers so that Spark and SQL draw identically).
# ---------------------------------------------------------------------------
LOCATION_WEIGHTS = [
    ("경기", 2691), ("서울", 1820), ("부산", 633), ("경남", 626),
    ("인천", 598), ("경북", 489), ("대구", 460), ("충남", 418),
    ("전남", 347), ("전북", 337), ("충북", 313), ("강원", 295),
    ("대전", 282), ("광주", 271), ("울산", 213), ("제주", 130),
    ("세종", 77),
]
GENDER_WEIGHTS = [("MALE", 4925), ("FEMALE", 4975), ("OTHER", 100)]
AGE_GROUP_WEIGHTS = [("teens", 4), ("20s", 20), ("30s", 28), ("40s", 25),
                     ("50s", 14), ("60s", 7), ("70plus", 2)]
# Age ranges per group; the 20s split 43 / 57 and the 70+ buckets.
AGE_GROUP_RANGES = {"teens": (14, 19), "30s": (30, 39), "40s": (40, 49),
                    "50s": (50, 59), "60s": (60, 69)}
AGE_20S_SPLIT = (43, [(20, 24), (25, 29)])
AGE_70PLUS_BUCKETS = [((70, 74), 55), ((75, 79), 27), ((80, 84), 13),
                      ((85, 89), 4), ((90, 99), 1)]
ORDER_BUCKETS = [(0, 0), (1, 1), (2, 5), (6, 20), (21, 50), (51, 100),
                 (101, 200), (201, 500)]
# Per age group, weights x10 (each row sums to 1000).
ORDER_WEIGHTS_BY_GROUP = {
    "teens": [700, 80, 170, 50, 0, 0, 0, 0],
    "20s": [200, 80, 350, 220, 100, 30, 15, 5],
    "30s": [70, 50, 220, 260, 220, 120, 50, 10],
    "40s": [120, 60, 280, 240, 180, 80, 30, 10],
    "50s": [180, 70, 330, 220, 120, 50, 25, 5],
    "60s": [380, 90, 280, 150, 70, 20, 8, 2],
    "70plus": [700, 90, 140, 50, 20, 0, 0, 0],
}

# Integer hash used for the draws (our choice; any mixing hash works).
HASH_PRIME = 2147483647
HASH_MULTS = {"gender": 1103515245, "location": 1664525, "group": 22695477,
              "age_split": 1140671485, "age": 134775813, "bucket": 214013,
              "order": 16843009}


# The generator is written as Spark SQL text over a step column (one parse
# per part instead of thousands of Column calls); all numbers come from the
# fixed values above.

def _arr(values) -> str:
    return "array(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v)
                                for v in values) + ")"


def _cond(category: str, operator: str, value_sql: str) -> str:
    return (f"named_struct('category', '{category}', 'operator', '{operator}', "
            f"'value', {value_sql})")


def _elt_sql(values, index_sql: str) -> str:
    return f"element_at({_arr(values)}, CAST({index_sql} AS INT))"


def gender_sql(n: str) -> str:
    g = f"CASE WHEN ({n} * {GENDER_MULT}) % 100 < 50 THEN 'MALE' ELSE 'FEMALE' END"
    return f"array({_cond('gender', 'EQUALS', g)})"


def location_sql(n: str, domain: str = "seed") -> str:
    """Region for step ``n``; ``domain='nation'`` maps it onto the derived
    account domain ``NATION_{(n*2654435761) % 25}``."""
    if domain == "nation":
        v = f"concat('NATION_', CAST(({n} * {LOCATION_MULT}) % 25 AS STRING))"
    else:
        r = f"(({n} * {LOCATION_MULT}) % 1000)"
        v = "CASE " + " ".join(f"WHEN {r} < {b} THEN '{name}'"
                               for b, name in LOCATION_LADDER) + " END"
    return f"array({_cond('location', 'EQUALS', v)})"


def _ranged_sql(n, mult, category, choices, pick, lows, highs, lo_op, hi_op) -> str:
    r = f"({n} * {mult})"
    whens = [f"WHEN {r} % 100 < {limit} THEN array({_cond(category, op, _elt_sql(vals, f'1 + {r} % {len(vals)}'))})"
             for limit, op, vals in choices]
    idx = _elt_sql(pick, f"1 + {r} % {len(pick)}")
    pair = (f"array({_cond(category, lo_op, _elt_sql(lows, idx))}, "
            f"{_cond(category, hi_op, _elt_sql(highs, idx))})")
    return "CASE " + " ".join(whens) + f" ELSE {pair} END"


def age_sql(n: str) -> str:
    return _ranged_sql(n, AGE_MULT, "age",
                       [(5, "EQUALS", AGE_EQUALS_VALUES), (25, "GTE", AGE_GTE_VALUES),
                        (45, "LT", AGE_LT_VALUES)],
                       AGE_RANGE_PICK, AGE_RANGE_GTE, AGE_RANGE_LT, "GTE", "LT")


def order_count_sql(n: str) -> str:
    return _ranged_sql(n, ORDER_MULT, "order_count",
                       [(3, "EQUALS", ORDER_EQUALS_VALUES), (58, "GTE", ORDER_GTE_VALUES),
                        (73, "LTE", ORDER_LTE_VALUES)],
                       ORDER_RANGE_PICK, ORDER_RANGE_GTE, ORDER_RANGE_LTE, "GTE", "LTE")


def ladder_sql(n: str, parts: dict[str, str]) -> str:
    """The id ladder: which parts, concatenated in order, for step ``n``."""
    whens = []
    for last, names in SEGMENT_LADDER:
        merged = f"concat({', '.join(parts[c] for c in names)})" if len(names) > 1 \
            else parts[names[0]]
        whens.append(f"WHEN {n} <= {last} THEN {merged}" if last is not None
                     else f"ELSE {merged}")
    return "to_json(CASE " + " ".join(whens) + " END)"


def part_sqls(n: str, domain: str = "seed") -> dict[str, str]:
    return {"gender": gender_sql(n), "age": age_sql(n), "order_count": order_count_sql(n),
            "location": location_sql(n, domain)}


def segment_conditions(n: str, domain: str = "seed") -> Column:
    """JSON text of the condition list for the step in column ``n``."""
    return F.expr(ladder_sql(n, part_sqls(n, domain)))


def generate_segments(ids: DataFrame, id_col: str = "segment_id", step_col: str | None = None,
                      as_of: dt.datetime = dt.datetime(2026, 5, 1),
                      domain: str = "seed") -> DataFrame:
    """One segment per input row.  ``step_col`` picks the ladder step (the id
    itself by default); ``created_at`` goes back ``n % 365`` days from
    ``as_of`` and ``updated_at`` is ``as_of`` (the insert time).  The four
    condition parts are computed once per row, then the ladder concatenates
    them."""
    ts = S.ntz_literal(as_of)
    parts = ids.select(F.col(id_col).cast("long").alias("segment_id"),
                       F.col(step_col or id_col).cast("long").alias("_n"))
    parts = parts.select("segment_id", "_n", *[
        F.expr(sql).alias(f"_p_{k}") for k, sql in part_sqls("_n", domain).items()])
    pn = F.col("_n")
    return parts.select(
        "segment_id",
        F.expr(ladder_sql("_n", {k: f"_p_{k}" for k in ("gender", "age", "order_count",
                                                         "location")})).alias("conditions"),
        (ts - F.make_dt_interval(days=(pn % 365).cast("int"))).alias("created_at"),
        ts.alias("updated_at"),
    )


def segment_ids(spark, count: int = 5000) -> DataFrame:
    """The reference's id sequence 1..count (G1)."""
    return spark.range(1, count + 1).withColumnRenamed("id", "segment_id")


def backfill_history(segments: DataFrame, start: dt.date = HISTORY_START,
                     end: dt.date = HISTORY_END) -> DataFrame:
    """Every segment x every day in [start, end], all INSERTED, with
    ``user_count = 1000 + (s*7 % 5000) + (dayofyear(d) % 100)``. The segments are
    dealt out before each becomes 120 rows: a table of few files or row groups
    would leave all days to as few tasks. Ranges keep neighbours together, which
    spares a later sort by segment; the number is given, since AQE would reduce
    it by the size of the ids alone."""
    parts = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = segments.select("segment_id").repartitionByRange(parts, "segment_id")
    days = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    s = F.col("segment_id")
    return (segments.select(s, F.explode(days).alias("metric_date"))
            .select(s, "metric_date",
                    (F.lit(1000) + (s * 7) % 5000
                     + F.dayofyear("metric_date") % 100).cast("long").alias("user_count"),
                    F.lit(S.INSERTED).alias("status")))


# ------------------------------ accounts ---------------------------------

def draw(ids: Column, salt: str, modulus: int) -> Column:
    """Deterministic integer in [0, modulus) from an id (J1/J2 building block).
    Two rounds: affine map mod a prime, then a square mod the prime; every
    intermediate stays below 2**63, so the same bigint arithmetic gives the
    same draws in Spark and in SQL."""
    p = HASH_PRIME
    x1 = ((ids % p) * HASH_MULTS[salt] + 12345) % p
    x2 = (x1 * x1 + 1013904223) % p
    return int_div(x2 * modulus, p)


def int_div(a: Column, b: int) -> Column:
    """Exact floor division of a non-negative bigint below 2**53."""
    return ((a - a % b) / F.lit(b)).cast("long")


def _pick(u: Column, weights: list[int]) -> Column:
    """0-based index of the weighted bucket holding draw ``u`` (a CASE chain
    over the cumulative weights: compiled code, no per-row lambda)."""
    expr, acc = None, 0
    for i, w in enumerate(weights[:-1]):
        acc += w
        expr = F.when(u < acc, F.lit(i)) if expr is None else expr.when(u < acc, F.lit(i))
    last = F.lit(len(weights) - 1)
    return last if expr is None else expr.otherwise(last)


def generate_accounts(ids: DataFrame, id_col: str = "user_id") -> DataFrame:
    """One account per input id with the seed's distributions.  Three
    layered projections (draws, bucket choices, values) keep each generated
    expression small; everything is compiled code."""
    uid = F.col(id_col).cast("long")
    loc_total = sum(w for _, w in LOCATION_WEIGHTS)
    draws = ids.select(
        uid.alias("user_id"),
        draw(uid, "gender", 10000).alias("_ug"),
        draw(uid, "location", loc_total).alias("_ul"),
        draw(uid, "group", 100).alias("_ugrp"),
        draw(uid, "age_split", 100).alias("_us"),
        draw(uid, "bucket", 1000).alias("_ub"),
        draw(uid, "age", 1 << 20).alias("_ua"),
        draw(uid, "order", 1 << 20).alias("_uo"))

    names = [n for n, _ in AGE_GROUP_WEIGHTS]
    grp = _pick(F.col("_ugrp"), [w for _, w in AGE_GROUP_WEIGHTS])
    picks = draws.select(
        "user_id", "_ua", "_uo", "_us",
        _pick(F.col("_ug"), [w for _, w in GENDER_WEIGHTS]).alias("_g"),
        _pick(F.col("_ul"), [w for _, w in LOCATION_WEIGHTS]).alias("_l"),
        grp.alias("_grp"),
        _pick(F.col("_us"), [w for _, w in AGE_70PLUS_BUCKETS]).alias("_b70"),
        *[_pick(F.col("_ub"), ORDER_WEIGHTS_BY_GROUP[n]).alias(f"_ob{i}")
          for i, n in enumerate(names)])

    # age range per group (J3): the 20s split 43/57, 70+ by bucket.
    pct20, ((a1, b1), (a2, b2)) = AGE_20S_SPLIT
    split, g = F.col("_us"), F.col("_grp")
    lo70 = F.element_at(F.array(*[F.lit(b[0]) for b, _ in AGE_70PLUS_BUCKETS]), F.col("_b70") + 1)
    hi70 = F.element_at(F.array(*[F.lit(b[1]) for b, _ in AGE_70PLUS_BUCKETS]), F.col("_b70") + 1)
    lo_e = hi_e = bucket = None
    for i, name in enumerate(names):
        if name == "20s":
            l_, h_ = (F.when(split < pct20, F.lit(a1)).otherwise(F.lit(a2)),
                      F.when(split < pct20, F.lit(b1)).otherwise(F.lit(b2)))
        elif name == "70plus":
            l_, h_ = lo70, hi70
        else:
            l_, h_ = F.lit(AGE_GROUP_RANGES[name][0]), F.lit(AGE_GROUP_RANGES[name][1])
        lo_e = F.when(g == i, l_) if lo_e is None else lo_e.when(g == i, l_)
        hi_e = F.when(g == i, h_) if hi_e is None else hi_e.when(g == i, h_)
        b = F.col(f"_ob{i}")
        bucket = F.when(g == i, b) if bucket is None else bucket.when(g == i, b)
    ranges = picks.select(
        "user_id", "_ua", "_uo", "_g", "_l",
        lo_e.cast("long").alias("_alo"), hi_e.cast("long").alias("_ahi"),
        bucket.alias("_bk"))

    # order count (J4): uniform inside the chosen bucket.
    b_lo = F.element_at(F.array(*[F.lit(x) for x, _ in ORDER_BUCKETS]), F.col("_bk") + 1)
    b_hi = F.element_at(F.array(*[F.lit(y) for _, y in ORDER_BUCKETS]), F.col("_bk") + 1)
    genders = F.array(*[F.lit(x) for x, _ in GENDER_WEIGHTS])
    locations = F.array(*[F.lit(x) for x, _ in LOCATION_WEIGHTS])
    span_a = F.col("_ahi") - F.col("_alo") + 1
    span_o = b_hi.cast("long") - b_lo.cast("long") + 1
    return ranges.select(
        "user_id",
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("name"),
        F.element_at(genders, F.col("_g") + 1).alias("gender"),
        (F.col("_alo") + int_div(F.col("_ua") * span_a, 1 << 20)).cast("int").alias("age"),
        F.element_at(locations, F.col("_l") + 1).alias("location"),
        (b_lo.cast("long") + int_div(F.col("_uo") * span_o, 1 << 20)).cast("int")
        .alias("order_count"),
    )
