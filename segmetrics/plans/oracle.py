"""SQL (DuckDB dialect) for every query in ``plans.catalog``.

The SQL re-derives accounts and segments from the given tables, validates the
JSON definitions, and counts each segment the plain way (one predicate per
condition, an account matches when all its conditions hold) -- nothing is
shared with the Spark plan except the fixed values (templates, generator
ladders, weights, bounds).
"""

from __future__ import annotations


from .. import schemas as S
from ..operators import seed
from ..sources import derived as D
from . import catalog as Q

RUN = f"DATE '{Q.RUN_DAY.isoformat()}'"
KNOWN = "('location', 'gender', 'age', 'order_count')"


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def _cond(cat: str, op: str, value_sql: str) -> str:
    return f"{{'category': '{cat}', 'operator': '{op}', 'value': {value_sql}}}"


# ------------------------------ generators --------------------------------

def _gender(n):
    return f"[{_cond('gender', 'EQUALS', f'CASE WHEN ({n} * {seed.GENDER_MULT}) % 100 < 50 THEN ' + _q('MALE') + ' ELSE ' + _q('FEMALE') + ' END')}]"


def _location(n, domain):
    if domain == "nation":
        v = f"'NATION_' || CAST(({n} * {seed.LOCATION_MULT}) % 25 AS VARCHAR)"
    else:
        r = f"(({n} * {seed.LOCATION_MULT}) % 1000)"
        v = "CASE " + " ".join(f"WHEN {r} < {b} THEN {_q(name)}"
                               for b, name in seed.LOCATION_LADDER) + " END"
    return f"[{_cond('location', 'EQUALS', v)}]"


def _ranged(n, mult, cat, eq_vals, first, second, third, pick, lows, highs,
            lo_op, hi_op):
    r = f"({n} * {mult})"
    (t1, op1, vals1), (t2, op2, vals2), (t3, op3, vals3) = first, second, third
    idx = f"{_list(pick)}[1 + {r} % {len(pick)}]"
    return (f"CASE WHEN {r} % 100 < {t1} THEN [{_cond(cat, op1, f'{_list(vals1)}[1 + {r} % {len(vals1)}]')}] "
            f"WHEN {r} % 100 < {t2} THEN [{_cond(cat, op2, f'{_list(vals2)}[1 + {r} % {len(vals2)}]')}] "
            f"WHEN {r} % 100 < {t3} THEN [{_cond(cat, op3, f'{_list(vals3)}[1 + {r} % {len(vals3)}]')}] "
            f"ELSE [{_cond(cat, lo_op, f'{_list(lows)}[{idx}]')}, {_cond(cat, hi_op, f'{_list(highs)}[{idx}]')}] END")


def _age(n):
    return _ranged(n, seed.AGE_MULT, "age", None,
                   (5, "EQUALS", seed.AGE_EQUALS_VALUES), (25, "GTE", seed.AGE_GTE_VALUES),
                   (45, "LT", seed.AGE_LT_VALUES), seed.AGE_RANGE_PICK,
                   seed.AGE_RANGE_GTE, seed.AGE_RANGE_LT, "GTE", "LT")


def _order(n):
    return _ranged(n, seed.ORDER_MULT, "order_count", None,
                   (3, "EQUALS", seed.ORDER_EQUALS_VALUES), (58, "GTE", seed.ORDER_GTE_VALUES),
                   (73, "LTE", seed.ORDER_LTE_VALUES), seed.ORDER_RANGE_PICK,
                   seed.ORDER_RANGE_GTE, seed.ORDER_RANGE_LTE, "GTE", "LTE")


def segment_json(n: str, domain: str) -> str:
    parts = {"gender": _gender(n), "location": _location(n, domain),
             "age": _age(n), "order_count": _order(n)}
    whens = []
    for last, names in seed.SEGMENT_LADDER:
        expr = parts[names[0]]
        for nm in names[1:]:
            expr = f"list_concat({expr}, {parts[nm]})"
        whens.append(f"WHEN {n} <= {last} THEN {expr}" if last is not None else f"ELSE {expr}")
    return "to_json(CASE " + " ".join(whens) + " END)::VARCHAR"


def _ts(n):
    return (f"strftime(TIMESTAMP '{Q.SEED_AS_OF:%Y-%m-%d %H:%M:%S}' - "
            f"to_days(CAST({n} % 365 AS INTEGER)), '%Y-%m-%d %H:%M:%S')")


def seed_segments_cte(domain="nation", step="(c_custkey * 7) % 5000 + 1"):
    return (f"SELECT 2 * c_custkey + 1 AS segment_id, {segment_json('n', domain)} AS conditions "
            f"FROM (SELECT c_custkey, {step} AS n FROM customer)")


EDGE_CTE = (
    "SELECT 2 * k + 2 AS segment_id, "
    "replace(replace(replace(t, '{n}', CAST(k % 25 AS VARCHAR)), '{a}', CAST(14 + k % 86 AS VARCHAR)), "
    "'{o}', CAST(k % 26 AS VARCHAR)) AS conditions FROM (SELECT c_custkey AS k, "
    "[" + ", ".join("NULL" if t is None else _q(t) for t in D.EDGE_TEMPLATES) + "]"
    f"[(c_custkey % {len(D.EDGE_TEMPLATES)}) + 1] AS t FROM customer)")

ACCOUNT_CTE = """SELECT CAST(c.c_custkey AS BIGINT) AS user_id, c.c_name AS name,
  CASE WHEN (c.c_custkey * 7919) % 10000 < 4925 THEN 'MALE'
       WHEN (c.c_custkey * 7919) % 10000 < 9900 THEN 'FEMALE' ELSE 'OTHER' END AS gender,
  CAST(14 + (c.c_custkey * 31) % 86 AS INTEGER) AS age,
  n.n_name AS location,
  CAST(COALESCE(o.n_orders, 0) AS INTEGER) AS order_count
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o
  ON o.o_custkey = c.c_custkey"""

# Written out here once more, so that a wrong pattern in the library shows.
HAS_TEXT = (r"'[^\x09-\x0D\x1C-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}]'")
STRICT_INT = "'^[-+]?[0-9]+$'"


def _pred(fold: bool = False) -> str:
    """Condition ``e`` on account ``a`` (NULL when it does not apply);
    ``fold`` compares case- and accent-insensitively."""
    f = (lambda x: f"lower(strip_accents({x}))") if fold else (lambda x: x)
    s = lambda c: (f"CASE e.operator WHEN 'EQUALS' THEN {f('a.' + c)} = {f('e.value')} "
                   f"WHEN 'NOT_EQUALS' THEN {f('a.' + c)} <> {f('e.value')} "
                   f"WHEN 'CONTAINS' THEN contains({f('a.' + c)}, {f('e.value')}) "
                   f"WHEN 'STARTS_WITH' THEN starts_with({f('a.' + c)}, {f('e.value')}) END")
    n = lambda c: (f"CASE e.operator WHEN 'EQUALS' THEN a.{c} = e.ival "
                   f"WHEN 'NOT_EQUALS' THEN a.{c} <> e.ival WHEN 'GT' THEN a.{c} > e.ival "
                   f"WHEN 'GTE' THEN a.{c} >= e.ival WHEN 'LT' THEN a.{c} < e.ival "
                   f"WHEN 'LTE' THEN a.{c} <= e.ival END")
    return (f"CASE e.category WHEN 'location' THEN {s('location')} "
            f"WHEN 'gender' THEN {s('gender')} WHEN 'age' THEN {n('age')} "
            f"WHEN 'order_count' THEN {n('order_count')} END")


def _validation(seg: str = "wseg", fold: bool = False) -> str:
    """CTEs vseg, elems, er, serr, eff, neff, counts over segment CTE ``seg``."""
    str_ops, num_ops = _in(S.STRING_OPERATORS), _in(S.NUMBER_OPERATORS)
    return f"""
vseg AS (SELECT segment_id, conditions,
                CASE WHEN json_valid(conditions) THEN conditions END AS vj FROM {seg}),
elems AS (
  SELECT segment_id, CAST(pos AS INTEGER) AS pos, json_type(e) AS et,
         json_extract_string(e, '$.category') AS category,
         json_extract_string(e, '$.operator') AS operator,
         json_extract_string(e, '$.value') AS value,
         json_type(e, '$.value') AS vt
  FROM (SELECT segment_id, pos, json_extract(vj, '$[' || pos || ']') AS e
        FROM (SELECT segment_id, vj, unnest(range(CAST(json_array_length(vj) AS BIGINT))) AS pos
              FROM vseg WHERE json_type(vj) = 'ARRAY'))),
er AS (
  SELECT *,
    COALESCE(regexp_matches(value, {HAS_TEXT}), false) AS has_text,
    CASE WHEN regexp_matches(value, {STRICT_INT}) THEN TRY_CAST(value AS INTEGER) END AS ival
  FROM elems),
er2 AS (
  SELECT *,
    CASE WHEN et <> 'NULL' AND et <> 'OBJECT' THEN 'invalid_condition'
         WHEN vt IN ('OBJECT', 'ARRAY') THEN 'invalid_condition'
         WHEN operator IS NOT NULL AND operator NOT IN {_in(S.OPERATORS)} THEN 'unknown_operator'
    END AS load_r,
    CASE WHEN et = 'NULL' THEN 'null_condition'
         WHEN NOT has_text THEN NULL
         WHEN category IS NULL THEN 'null_category'
         WHEN category IN ('location', 'gender') THEN
           CASE WHEN operator IS NULL THEN 'null_operator'
                WHEN operator NOT IN {str_ops} THEN 'unsupported_operator' END
         WHEN category IN ('age', 'order_count') THEN
           CASE WHEN ival IS NULL THEN 'invalid_number'
                WHEN operator IS NULL THEN 'null_operator'
                WHEN operator NOT IN {num_ops} THEN 'unsupported_operator' END
    END AS loop_r
  FROM er),
serr AS (
  SELECT s.segment_id,
    CASE WHEN s.conditions IS NOT NULL AND s.vj IS NULL THEN 'invalid_json'
         WHEN s.vj IS NOT NULL AND json_type(s.vj) NOT IN ('ARRAY', 'NULL') THEN 'not_array'
         ELSE COALESCE(l.r, p.r) END AS error_reason
  FROM vseg s
  LEFT JOIN (SELECT segment_id, arg_min(load_r, pos) AS r FROM er2
             WHERE load_r IS NOT NULL GROUP BY segment_id) l ON l.segment_id = s.segment_id
  LEFT JOIN (SELECT segment_id, arg_min(loop_r, pos) AS r FROM er2
             WHERE loop_r IS NOT NULL GROUP BY segment_id) p ON p.segment_id = s.segment_id),
eff AS (
  SELECT e.segment_id, e.pos, e.category, e.operator, e.value, e.ival
  FROM er2 e JOIN serr s ON s.segment_id = e.segment_id
  WHERE s.error_reason IS NULL AND e.et = 'OBJECT' AND e.has_text AND e.category IN {KNOWN}),
neff AS (SELECT segment_id, count(*) AS k FROM eff GROUP BY segment_id),
hits AS (
  SELECT e.segment_id, a.user_id, count(*) AS m
  FROM eff e JOIN account a ON ({_pred(fold)})
  GROUP BY e.segment_id, a.user_id),
cnt AS (
  SELECT h.segment_id, count(*) AS c FROM hits h JOIN neff n ON n.segment_id = h.segment_id
  WHERE h.m = n.k GROUP BY h.segment_id),
counts AS (
  SELECT s.segment_id,
    CAST(CASE WHEN s.error_reason IS NOT NULL THEN 0
              WHEN n.k IS NULL THEN (SELECT count(*) FROM account)
              ELSE COALESCE(c.c, 0) END AS BIGINT) AS user_count,
    s.error_reason
  FROM serr s LEFT JOIN neff n ON n.segment_id = s.segment_id
  LEFT JOIN cnt c ON c.segment_id = s.segment_id)"""


def _base(with_counts: bool = True, fold: bool = False) -> str:
    ctes = [f"account AS ({ACCOUNT_CTE})",
            f"sseg AS ({seed_segments_cte()})",
            f"eseg AS ({EDGE_CTE})",
            "wseg AS (SELECT * FROM sseg UNION ALL SELECT * FROM eseg)"]
    out = "WITH " + ",\n".join(ctes)
    if with_counts:
        out += "," + _validation(fold=fold)
    return out


HISTORY = f"""history AS (
  SELECT s.segment_id, CAST(d AS DATE) AS metric_date,
         CAST(1000 + (s.segment_id * 7) % 5000 + dayofyear(CAST(d AS DATE)) % 100 AS BIGINT) AS user_count,
         'INSERTED' AS status
  FROM wseg s,
       (SELECT unnest(generate_series(DATE '{seed.HISTORY_START}', DATE '{seed.HISTORY_END}',
                                      INTERVAL 1 DAY)) AS d) dt)"""

CRASH = f"""crash AS (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN -sid ELSE sid END AS segment_id,
         {RUN} AS metric_date,
         CAST(CASE WHEN c_mktsegment = 'FURNITURE' THEN k % 100
                   WHEN c_mktsegment = 'HOUSEHOLD' THEN k % 1000 ELSE 0 END AS BIGINT) AS user_count,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'PENDING' WHEN 'FURNITURE' THEN 'COUNTED'
              WHEN 'HOUSEHOLD' THEN 'INSERTED' WHEN 'MACHINERY' THEN 'PENDING' END AS status
  FROM (SELECT c_custkey AS k, c_mktsegment,
               unnest([2 * c_custkey + 1, 2 * c_custkey + 2]) AS sid FROM customer)
  WHERE c_mktsegment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'))"""


def _day_run(metrics: str) -> str:
    """CTEs init, after, final, run_errors for the run day over ``metrics``."""
    return f"""
existing AS (SELECT segment_id, metric_date, user_count, status FROM {metrics}
             WHERE metric_date = {RUN}),
init AS (
  SELECT * FROM existing
  UNION ALL
  SELECT segment_id, {RUN} AS metric_date, CAST(0 AS BIGINT) AS user_count, 'PENDING' AS status
  FROM wseg WHERE segment_id NOT IN (SELECT segment_id FROM existing)),
after AS (
  SELECT p.segment_id, p.metric_date,
    CAST(CASE WHEN c.segment_id IS NOT NULL AND c.error_reason IS NULL THEN c.user_count ELSE 0 END
         AS BIGINT) AS user_count,
    CASE WHEN c.segment_id IS NOT NULL AND c.error_reason IS NULL THEN 'COUNTED' ELSE 'PENDING' END
      AS status
  FROM init p LEFT JOIN counts c ON c.segment_id = p.segment_id WHERE p.status = 'PENDING'
  UNION ALL
  SELECT * FROM init WHERE status <> 'PENDING'),
final AS (
  SELECT segment_id, metric_date, user_count,
         CASE WHEN status = 'COUNTED' THEN 'INSERTED' ELSE status END AS status FROM after),
run_errors AS (
  SELECT p.segment_id, COALESCE(c.error_reason, 'segment_missing') AS error_reason
  FROM init p LEFT JOIN counts c ON c.segment_id = p.segment_id
  WHERE p.status = 'PENDING' AND (c.segment_id IS NULL OR c.error_reason IS NOT NULL))"""


def _single_pred(cat, op, value) -> str:
    col = cat
    if cat in S.NUMBER_CATEGORIES:
        v = str(int(value))
        sym = {"EQUALS": "=", "NOT_EQUALS": "<>", "GT": ">", "GTE": ">=",
               "LT": "<", "LTE": "<="}[op]
        return f"{col} {sym} {v}"
    return {"EQUALS": f"{col} = {_q(value)}", "NOT_EQUALS": f"{col} <> {_q(value)}",
            "CONTAINS": f"contains({col}, {_q(value)})",
            "STARTS_WITH": f"starts_with({col}, {_q(value)})"}[op]


# ------------------------------ accounts seed ------------------------------

def _draw(uid: str, salt: str, modulus: int) -> str:
    p = seed.HASH_PRIME
    x1 = f"((({uid}) % {p}) * {seed.HASH_MULTS[salt]} + 12345) % {p}"
    x2 = f"(({x1}) * ({x1}) + 1013904223) % {p}"
    return f"((({x2}) * {modulus}) // {p})"


def _pick(u: str, weights) -> str:
    cum, acc = [], 0
    for w in weights:
        acc += w
        cum.append(acc)
    return f"len(list_filter({_list(cum)}, lambda t: t <= {u}))"


def account_seed_sql() -> str:
    uid = "user_id"
    grp = _pick(_draw(uid, "group", 100), [w for _, w in seed.AGE_GROUP_WEIGHTS])
    split = _draw(uid, "age_split", 100)
    b70 = _pick(split, [w for _, w in seed.AGE_70PLUS_BUCKETS])
    names = [n for n, _ in seed.AGE_GROUP_WEIGHTS]
    pct, ((a1, b1), (a2, b2)) = seed.AGE_20S_SPLIT
    lo_cases, hi_cases, bucket_cases = [], [], []
    for i, name in enumerate(names):
        if name == "20s":
            lo, hi = (f"CASE WHEN s < {pct} THEN {a1} ELSE {a2} END",
                      f"CASE WHEN s < {pct} THEN {b1} ELSE {b2} END")
        elif name == "70plus":
            lo = f"{_list([b[0] for b, _ in seed.AGE_70PLUS_BUCKETS])}[b70 + 1]"
            hi = f"{_list([b[1] for b, _ in seed.AGE_70PLUS_BUCKETS])}[b70 + 1]"
        else:
            lo, hi = map(str, seed.AGE_GROUP_RANGES[name])
        lo_cases.append(f"WHEN {i} THEN {lo}")
        hi_cases.append(f"WHEN {i} THEN {hi}")
        bucket_cases.append(
            f"WHEN {i} THEN {_pick(_draw(uid, 'bucket', 1000), seed.ORDER_WEIGHTS_BY_GROUP[name])}")
    loc_total = sum(w for _, w in seed.LOCATION_WEIGHTS)
    return f"""
WITH ids AS (SELECT c_custkey + 1 AS user_id FROM customer),
d1 AS (
  SELECT user_id,
    {_pick(_draw(uid, 'gender', 10000), [w for _, w in seed.GENDER_WEIGHTS])} AS g,
    {_pick(_draw(uid, 'location', loc_total), [w for _, w in seed.LOCATION_WEIGHTS])} AS l,
    {grp} AS grp, {split} AS s, {b70} AS b70
  FROM ids),
d2 AS (
  SELECT *, CASE grp {' '.join(lo_cases)} END AS age_lo,
            CASE grp {' '.join(hi_cases)} END AS age_hi,
            CASE grp {' '.join(bucket_cases)} END AS bucket
  FROM d1),
d3 AS (
  SELECT *, {_list([x for x, _ in seed.ORDER_BUCKETS])}[bucket + 1] AS o_lo,
            {_list([y for _, y in seed.ORDER_BUCKETS])}[bucket + 1] AS o_hi
  FROM d2)
SELECT CAST(user_id AS BIGINT) AS user_id, 'user_' || CAST(user_id AS VARCHAR) AS name,
  {_list([g for g, _ in seed.GENDER_WEIGHTS])}[g + 1] AS gender,
  CAST(age_lo + ({_draw(uid, 'age', 1 << 20)} * (age_hi - age_lo + 1)) // {1 << 20} AS INTEGER) AS age,
  {_list([n for n, _ in seed.LOCATION_WEIGHTS])}[l + 1] AS location,
  CAST(o_lo + ({_draw(uid, 'order', 1 << 20)} * (o_hi - o_lo + 1)) // {1 << 20} AS INTEGER)
    AS order_count
FROM d3"""


# ------------------------------ latency ------------------------------------

def _bounds_sql() -> str:
    """Two bounds an octave from 1 ms up to 5 minutes, then infinity."""
    return "list_append(list_transform(range(37), lambda i: round(pow(2.0, i / 2.0), 6)), 'inf'::DOUBLE)"


BUCKETS = f"""buckets AS (
  SELECT et.event_type, b.le, CAST(count(e.value) AS BIGINT) AS cum_count
  FROM (SELECT DISTINCT event_type FROM events) et
  CROSS JOIN (SELECT unnest({_bounds_sql()}) AS le) b
  LEFT JOIN events e ON e.event_type IS NOT DISTINCT FROM et.event_type AND e.value <= b.le
  GROUP BY et.event_type, b.le)"""


# ------------------------------ the queries --------------------------------

def build() -> dict[str, str]:
    out = {}
    base_acc = f"WITH account AS ({ACCOUNT_CTE})"
    out["account_profile"] = f"{base_acc} SELECT * FROM account"
    out["segment_parse"] = (_base() + " SELECT segment_id, pos, category, operator, value "
                            "FROM elems")
    out["segment_normalize"] = _base() + """
SELECT s.segment_id,
  CAST(COALESCE(bit_or(CASE e.category WHEN 'location' THEN 8 WHEN 'gender' THEN 4
                        WHEN 'age' THEN 2 WHEN 'order_count' THEN 1 END), 0) AS INTEGER) AS signature,
  CAST(count(e.segment_id) AS INTEGER) AS n_conditions,
  CAST(max(CASE WHEN e.category = 'age' AND e.operator IN ('EQUALS', 'GTE') THEN e.ival
                WHEN e.category = 'age' AND e.operator = 'GT' THEN CAST(e.ival AS BIGINT) + 1 END)
       AS BIGINT) AS age_lo,
  CAST(min(CASE WHEN e.category = 'age' AND e.operator IN ('EQUALS', 'LTE') THEN e.ival
                WHEN e.category = 'age' AND e.operator = 'LT' THEN CAST(e.ival AS BIGINT) - 1 END)
       AS BIGINT) AS age_hi,
  CAST(max(CASE WHEN e.category = 'order_count' AND e.operator IN ('EQUALS', 'GTE') THEN e.ival
                WHEN e.category = 'order_count' AND e.operator = 'GT' THEN CAST(e.ival AS BIGINT) + 1 END)
       AS BIGINT) AS order_count_lo,
  CAST(min(CASE WHEN e.category = 'order_count' AND e.operator IN ('EQUALS', 'LTE') THEN e.ival
                WHEN e.category = 'order_count' AND e.operator = 'LT' THEN CAST(e.ival AS BIGINT) - 1 END)
       AS BIGINT) AS order_count_hi
FROM serr s LEFT JOIN eff e ON e.segment_id = s.segment_id
WHERE s.error_reason IS NULL
GROUP BY s.segment_id"""
    out["segment_errors"] = (_base() + " SELECT segment_id, error_reason FROM serr "
                             "WHERE error_reason IS NOT NULL")
    for key, (cat, op, value) in Q.SINGLE_PREDICATES.items():
        out[key] = f"{base_acc} SELECT * FROM account WHERE {_single_pred(cat, op, value)}"
    out["pred_collation_ci_ai"] = (
        f"{base_acc} SELECT * FROM account WHERE lower(strip_accents(gender)) = 'male' "
        "AND contains(lower(strip_accents(location)), 'tion_2')")
    out["count_match_all"] = _base() + """
SELECT c.segment_id, c.user_count FROM counts c
WHERE c.error_reason IS NULL AND c.segment_id NOT IN (SELECT segment_id FROM neff)"""
    one = " AND ".join(_single_pred(c, o, v) for c, o, v in Q.ONE_SEGMENT)
    out["count_one_segment"] = (f"{base_acc} SELECT CAST(count(*) AS BIGINT) AS user_count "
                                f"FROM account WHERE {one}")
    out["count_all_segments"] = _base() + " SELECT segment_id, user_count, error_reason FROM counts"
    out["count_all_segments_ci"] = (_base(fold=True) +
                                    " SELECT segment_id, user_count, error_reason FROM counts")
    out["segment_seed"] = (
        f"WITH s AS (SELECT c_custkey + 1 AS segment_id, (c_custkey * 7) % 5000 + 1 AS n "
        f"FROM customer) SELECT segment_id, {segment_json('n', 'seed')} AS conditions, "
        f"{_ts('n')} AS created_at, "
        f"strftime(TIMESTAMP '{Q.SEED_AS_OF:%Y-%m-%d %H:%M:%S}', '%Y-%m-%d %H:%M:%S') AS updated_at "
        f"FROM s")
    out["account_seed"] = account_seed_sql()
    hist = _base(False) + ",\n" + HISTORY
    out["metric_backfill"] = hist + " SELECT * FROM history"
    with_crash = (_base() + ",\n" + HISTORY + ",\n" + CRASH +
                  ",\nmetrics AS (SELECT * FROM history UNION ALL SELECT * FROM crash)," +
                  _day_run("metrics"))
    first_run = (_base() + ",\n" + HISTORY + "," + _day_run("history"))
    out["metric_init_day"] = with_crash + " SELECT * FROM init"
    out["metric_pending_page"] = (with_crash + " SELECT * FROM init WHERE status = 'PENDING' "
                                  f"ORDER BY segment_id LIMIT {Q.PAGE_SIZE} "
                                  f"OFFSET {Q.PAGE * Q.PAGE_SIZE}")
    out["metric_count_day"] = with_crash + " SELECT * FROM after"
    out["metric_mark_completed"] = (
        _base(False) + ",\n" + CRASH + " SELECT segment_id, metric_date, user_count, "
        "CASE WHEN status = 'COUNTED' THEN 'INSERTED' ELSE status END AS status FROM crash")
    out["metric_daily_run"] = first_run + " SELECT * FROM final"
    out["metric_daily_rerun"] = with_crash + " SELECT * FROM final"
    out["metric_run_errors"] = with_crash + " SELECT * FROM run_errors"
    probes = ", ".join(f"(DATE '{d.isoformat()}')" for d in Q.PROBE_DAYS)
    out["metric_exists_day"] = (
        _base(False) + ",\n" + HISTORY + ",\n" + CRASH +
        ",\nmetrics AS (SELECT * FROM history UNION ALL SELECT * FROM crash)"
        f" SELECT p.d AS metric_date, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_rows,"
        f" COALESCE(c.n, 0) > 0 AS has_rows FROM (VALUES {probes}) p(d) LEFT JOIN"
        " (SELECT metric_date, count(*) AS n FROM metrics GROUP BY metric_date) c"
        " ON c.metric_date = p.d")
    trend_where = (f"segment_id = {Q.TREND_SEGMENT} AND metric_date BETWEEN "
                   f"DATE '{Q.TREND_START}' AND DATE '{Q.TREND_END}'")
    out["segment_trend"] = (hist + " SELECT metric_date AS date, user_count AS count "
                            f"FROM history WHERE {trend_where} ORDER BY date")
    out["segment_trends"] = (
        hist + " SELECT h.segment_id, h.metric_date AS date, h.user_count AS count "
        "FROM history h JOIN sseg s ON s.segment_id = h.segment_id "
        f"WHERE h.metric_date BETWEEN DATE '{Q.TREND_START}' AND DATE '{Q.TREND_END}'")
    out["segment_trend_json"] = (
        hist + " SELECT json_object('date', strftime(metric_date, '%Y-%m-%d'), "
        f"'count', user_count)::VARCHAR AS json FROM history WHERE {trend_where}")
    out["dq_unique_key"] = with_crash + """
SELECT segment_id, metric_date, CAST(count(*) AS BIGINT) AS n
FROM (SELECT * FROM crash UNION ALL SELECT * FROM final)
GROUP BY segment_id, metric_date HAVING count(*) > 1"""
    cols = ["user_id", "name", "gender", "age", "location", "order_count"]
    out["dq_not_null"] = base_acc + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) "
        f"AS null_count FROM account" for c in cols)
    old_n, new_n = "(c_custkey * 7) % 5000 + 1", "(c_custkey * 7 + 1) % 5000 + 1"
    out["segment_touch_updated"] = f"""
WITH o AS (SELECT c_custkey + 1 AS segment_id, n, {segment_json('n', 'nation')} AS conditions
           FROM (SELECT c_custkey, {old_n} AS n FROM customer)),
     w AS (SELECT c_custkey + 1 AS segment_id, {segment_json('n', 'nation')} AS conditions
           FROM (SELECT c_custkey, {new_n} AS n FROM customer))
SELECT o.segment_id, o.conditions IS DISTINCT FROM w.conditions AS changed,
  {_ts('o.n')} AS created_at,
  CASE WHEN o.conditions IS DISTINCT FROM w.conditions THEN '2026-05-02 09:30:00'
       ELSE strftime(TIMESTAMP '{Q.SEED_AS_OF:%Y-%m-%d %H:%M:%S}', '%Y-%m-%d %H:%M:%S') END
    AS updated_at
FROM o JOIN w ON o.segment_id = w.segment_id"""
    out["latency_summary"] = """
SELECT event_type, count(value) AS n, round(sum(value), 6) AS total, round(avg(value), 6) AS mean,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99
FROM events GROUP BY event_type"""
    out["latency_buckets"] = f"WITH {BUCKETS} SELECT event_type, le, cum_count FROM buckets"
    out["latency_bucket_tail"] = (
        f"WITH {BUCKETS} SELECT le, CAST(sum(cum_count) AS BIGINT) AS cum_count FROM buckets "
        "GROUP BY le ORDER BY le DESC LIMIT 25")
    out["latency_histogram_quantile"] = f"""
WITH {BUCKETS},
b AS (
  SELECT event_type, le, cum_count,
    COALESCE(lag(le) OVER w, 0.0) AS prev_le, COALESCE(lag(cum_count) OVER w, 0) AS prev_cum,
    max(cum_count) OVER (PARTITION BY event_type) AS total,
    max(CASE WHEN le <> 'inf'::DOUBLE THEN le END) OVER (PARTITION BY event_type) AS max_finite
  FROM buckets WINDOW w AS (PARTITION BY event_type ORDER BY le)),
x AS (SELECT b.*, q.q, q.q * b.total AS rank
      FROM b, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) q(q)),
pick AS (SELECT *, row_number() OVER (PARTITION BY event_type, q ORDER BY le) AS r
         FROM x WHERE cum_count >= rank)
SELECT event_type, q,
  round(CASE WHEN total = 0 THEN 'nan'::DOUBLE WHEN le = 'inf'::DOUBLE THEN max_finite
             WHEN cum_count = prev_cum THEN le
             ELSE prev_le + (le - prev_le) * (rank - prev_cum) / (cum_count - prev_cum) END, 6)
    AS value
FROM pick WHERE r = 1"""
    ev = ("ev AS (SELECT CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type, value FROM events)")
    out["latency_summary_null"] = f"WITH {ev} " + out["latency_summary"].replace("FROM events", "FROM ev")
    out["latency_buckets_null"] = (f"WITH {ev}, {BUCKETS.replace('events', 'ev')} "
                                   "SELECT event_type, le, cum_count FROM buckets")
    out["latency_quantile_total"] = f"""
WITH {BUCKETS},
s AS (SELECT le, sum(cum_count) AS cum FROM buckets GROUP BY le),
p AS (SELECT le, cum, COALESCE((SELECT max(z.le) FROM s z WHERE z.le < s.le), 0.0) AS below,
             COALESCE((SELECT max(z.cum) FROM s z WHERE z.le < s.le), 0) AS before FROM s),
r AS (SELECT q, q * (SELECT max(cum) FROM s) AS rank
      FROM (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) v(q)),
h AS (SELECT r.q, r.rank, (SELECT min(p.le) FROM p WHERE p.cum >= r.rank) AS le FROM r)
SELECT h.q, round(CASE WHEN h.le = 'inf'::DOUBLE THEN (SELECT max(le) FROM s WHERE le <> 'inf'::DOUBLE)
                       WHEN p.cum = p.before THEN p.le
                       ELSE p.below + (p.le - p.below) * (h.rank - p.before) / (p.cum - p.before) END, 6) AS value
FROM h JOIN p ON p.le = h.le"""
    out["segment_page"] = _base(False) + f"""
SELECT segment_id, conditions, (SELECT count(*) FROM wseg) AS total,
       (SELECT max(segment_id) FROM wseg) > max(segment_id) OVER () AS has_next
FROM (SELECT segment_id, conditions FROM wseg WHERE segment_id > {Q.AFTER_SEGMENT}
      ORDER BY segment_id LIMIT {Q.PAGE_SIZE})"""
    out["segment_page_end"] = _base(False) + f"""
SELECT NULL AS segment_id, NULL AS conditions, count(*) AS total, count(*) FILTER (segment_id > {Q.BEHIND_LAST}) > 0 AS has_next FROM wseg"""
    out["segment_trends_closed"] = out["segment_trends"]
    return out


ORACLE_SQL = build()
