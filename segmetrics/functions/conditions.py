"""Parse, validate and normalize segment definitions with native Spark
expressions (no Python UDF).

A segment's ``conditions`` column is raw JSON text.  ``element_rows`` parses
it once (variant) and gives one row per array element; ``normalize_segments``
applies the rules per element and folds them back to one row per segment:

* ``error_reason`` -- null for a valid segment, else why it cannot be counted;
* ``effective``    -- the conditions that take part in the count (blank
  values skipped, unknown categories ignored), with numbers parsed;
* ``signature``    -- bit set of the columns those conditions touch;
* per string column: the mode used by the keyed count (``none`` / ``eq`` /
  ``scan`` / ``ne``), the equality key, the scan driver and the excluded values;
* per numeric column: inclusive ``lo`` / ``hi`` bounds (bigint, so
  ``GT 2147483647`` cannot overflow) and the excluded values.

Validation order, per condition in list order: null element, blank value
(skip), null category, unknown category (skip), number parse, null operator,
operator support.  JSON-level problems (malformed text, not an array, an
element that is not an object, an operator outside the nine names) come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def has_text(value: Column) -> Column:
    """Java ``StringUtils.hasText``: not null and some non-whitespace char."""
    return F.coalesce(value.rlike(S.HAS_TEXT_PATTERN), F.lit(False))


def strict_int(value: Column) -> Column:
    """Java ``Integer.parseInt``: sign + ASCII digits, int32 range, else null."""
    return F.when(value.rlike(S.STRICT_INT_PATTERN), value.try_cast("int"))


EFFECTIVE_TYPE = ("array<struct<pos:int,category:string,operator:string,"
                  "value:string,ival:int>>")


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# Validation rules over one element row (columns is_null, is_object, nested
# (an object or array as the value), category, operator, value, has_text, ival), as SQL expressions.
LOAD_REASON_SQL = (
    f"CASE WHEN NOT is_null AND NOT is_object THEN '{S.INVALID_CONDITION}' "
    f"WHEN nested THEN '{S.INVALID_CONDITION}' "
    f"WHEN operator IS NOT NULL AND operator NOT IN {_in(S.OPERATORS)} "
    f"THEN '{S.UNKNOWN_OPERATOR}' END")
LOOP_REASON_SQL = (
    f"CASE WHEN is_null THEN '{S.NULL_CONDITION}' "
    f"WHEN NOT has_text THEN NULL "
    f"WHEN category IS NULL THEN '{S.NULL_CATEGORY}' "
    f"WHEN category IN {_in(S.STRING_CATEGORIES)} THEN "
    f"CASE WHEN operator IS NULL THEN '{S.NULL_OPERATOR}' "
    f"WHEN operator NOT IN {_in(S.STRING_OPERATORS)} THEN '{S.UNSUPPORTED_OPERATOR}' END "
    f"WHEN category IN {_in(S.NUMBER_CATEGORIES)} THEN "
    f"CASE WHEN ival IS NULL THEN '{S.INVALID_NUMBER}' "
    f"WHEN operator IS NULL THEN '{S.NULL_OPERATOR}' "
    f"WHEN operator NOT IN {_in(S.NUMBER_OPERATORS)} THEN '{S.UNSUPPORTED_OPERATOR}' END END")
EFFECTIVE_SQL = (f"coalesce(present AND NOT is_null AND is_object AND has_text "
                 f"AND category IN {_in(S.KNOWN_CATEGORIES)}, false)")


def element_rows(segments: DataFrame, key: str = "segment_id") -> DataFrame:
    """A2: one row per element of each segment's JSON array (a segment whose
    text is not an array keeps one row with null element fields), with the
    segment-level JSON problem, the parsed number and the has-text flag.
    Values keep their JSON text (``20.0`` stays ``20.0``), so the strict
    number parse sees what the definition says."""
    parsed = segments.selectExpr(*dict.fromkeys([key, "conditions"]), "try_parse_json(conditions) AS _v",
                                 "from_json(conditions, 'array<string>') AS _t")
    rows = parsed.selectExpr(
        key, "_t",
        f"CASE WHEN conditions IS NOT NULL AND _v IS NULL THEN '{S.INVALID_JSON}' WHEN _v IS NOT NULL AND NOT is_variant_null(_v) "
        f"AND try_variant_get(_v, '$', 'array<variant>') IS NULL THEN '{S.NOT_ARRAY}' END AS json_reason",
        "posexplode_outer(try_variant_get(_v, '$', 'array<variant>')) AS (pos, _e)")
    rows = rows.selectExpr(
        key, "json_reason", "pos", "_e IS NOT NULL AS present", "is_variant_null(_e) AS is_null",
        "startswith(schema_of_variant(_e), 'OBJECT') AS is_object",
        "coalesce(schema_of_variant(try_variant_get(_e, '$.value', 'variant')) RLIKE '^(OBJECT|ARRAY)', false) AS nested",
        "try_variant_get(_e, '$.category', 'string') AS category", "try_variant_get(_e, '$.operator', 'string') AS operator",
        "from_json(get(_t, pos), 'struct<value:string>').value AS value")
    return rows.withColumns({"has_text": has_text(F.col("value")),
                             "ival": F.when(F.expr(f"category IN {_in(S.NUMBER_CATEGORIES)}"), strict_int(F.col("value")))})


def collated(c: Column, collation: str | None) -> Column:
    return F.collate(c, collation) if collation else c


def string_match(op: Column, pattern: Column, x: Column,
                 collation: str | None = None) -> Column:
    """One string condition on value ``x`` (null-safe: null -> false)."""
    cx, cp = collated(x, collation), collated(pattern, collation)
    m = (F.when(op == "EQUALS", cx == cp)
         .when(op == "NOT_EQUALS", cx != cp)
         .when(op == "CONTAINS", F.contains(cx, cp))
         .when(op == "STARTS_WITH", F.startswith(cx, cp)))
    return F.coalesce(m, F.lit(False))


def number_match(op: Column, ival: Column, x: Column) -> Column:
    m = (F.when(op == "EQUALS", x == ival)
         .when(op == "NOT_EQUALS", x != ival)
         .when(op == "GT", x > ival)
         .when(op == "GTE", x >= ival)
         .when(op == "LT", x < ival)
         .when(op == "LTE", x <= ival))
    return F.coalesce(m, F.lit(False))


def bare_test(operator: str, x: Column, value: Column) -> Column:
    """One condition as the plain comparison (null where ``x`` is null)."""
    return {"EQUALS": lambda: x == value, "NOT_EQUALS": lambda: x != value,
            "GT": lambda: x > value, "GTE": lambda: x >= value,
            "LT": lambda: x < value, "LTE": lambda: x <= value,
            "CONTAINS": lambda: F.contains(x, value),
            "STARTS_WITH": lambda: F.startswith(x, value)}[operator]()


def condition_match(e: Column, row: dict[str, Column],
                    collation: str | None = None) -> Column:
    """An effective condition evaluated on an account-like row."""
    return (F.when(e.category == "location",
                   string_match(e.operator, e.value, row["location"], collation))
            .when(e.category == "gender",
                  string_match(e.operator, e.value, row["gender"], collation))
            .when(e.category == "age", number_match(e.operator, e.ival, row["age"]))
            .otherwise(number_match(e.operator, e.ival, row["order_count"])))


def all_match(effective: Column, row: dict[str, Column],
              collation: str | None = None) -> Column:
    """AND of every effective condition (empty / null list -> true)."""
    return F.coalesce(F.forall(F.coalesce(effective, F.array()),
                               lambda e: condition_match(e, row, collation)),
                      F.lit(False))


def normalize_texts(segments: DataFrame, collation: str | None = None) -> DataFrame:
    """One row per distinct ``text`` (null too): error, effective conditions,
    signature and the per-column parts the keyed count needs.

    Relational form: the JSON is parsed once, its elements become rows
    (``element_rows``), every per-condition rule is a compiled expression, and
    one ``groupBy(conditions)`` folds them back.  The groups are a text's own
    conditions (a handful).  Rules and folds are SQL expressions (parsed once each)."""
    # as many tasks as a shuffle has: parsing costs more than the size of the texts suggests
    tasks = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = segments.select("conditions").distinct().repartition(tasks, "conditions")
    rows = element_rows(texts, "conditions").select(
        "*", F.expr(LOAD_REASON_SQL).alias("load_r"), F.expr(LOOP_REASON_SQL).alias("loop_r"),
        F.expr(EFFECTIVE_SQL).alias("eff"))
    item = ("named_struct('pos', pos, 'category', category, 'operator', operator, 'value', value, 'ival', ival, "
            "'load_r', load_r, 'loop_r', loop_r, 'eff', eff)")
    # one list for each text; what follows works on its few elements
    g = rows.groupBy("conditions").agg(F.expr("first(json_reason) AS json_reason"),
                                       F.expr(f"array_sort(collect_list(CASE WHEN pos IS NOT NULL THEN {item} END)) AS items"))
    own = "named_struct('pos', x.pos, 'category', x.category, 'operator', x.operator, 'value', x.value, 'ival', x.ival)"
    g = g.selectExpr("*", f"CAST(transform(filter(items, x -> x.eff), x -> {own}) AS {EFFECTIVE_TYPE}) AS effective")
    g = g.selectExpr("*", *[f"filter(effective, x -> x.category = '{c}') AS {c}_conds" for c in S.KNOWN_CATEGORIES])
    cols = ["conditions AS text",
            "coalesce(json_reason, get(filter(items, x -> x.load_r IS NOT NULL), 0).load_r, get(filter(items, x -> x.loop_r IS NOT NULL), 0).loop_r) AS error_reason",
            "effective", " | ".join(f"CASE WHEN size({c}_conds) > 0 THEN {b} ELSE 0 END" for c, b in S.CATEGORY_BITS.items()) + " AS signature"]
    for c in S.STRING_CATEGORIES:
        eq, scan = f"filter({c}_conds, x -> x.operator = 'EQUALS')", f"filter({c}_conds, x -> x.operator IN ('STARTS_WITH', 'CONTAINS'))"
        value = f"collate(x.value, '{collation}')" if collation else "x.value"
        cols += [f"{c}_conds", f"CASE WHEN size({c}_conds) = 0 THEN 'none' WHEN size({eq}) > 0 THEN 'eq' WHEN size({scan}) > 0 THEN 'scan' ELSE 'ne' END AS {c}_mode",
                 f"get({eq}, 0).value AS {c}_eq", f"get({scan}, 0).operator AS {c}_drv_op", f"get({scan}, 0).value AS {c}_drv_value",
                 f"array_distinct(transform(filter({c}_conds, x -> x.operator = 'NOT_EQUALS'), x -> {value})) AS {c}_ne"]
    for c in S.NUMBER_CATEGORIES:
        n = "CAST(x.ival AS BIGINT)"
        cols += [f"array_max(transform({c}_conds, x -> CASE WHEN x.operator IN ('EQUALS', 'GTE') THEN {n} WHEN x.operator = 'GT' THEN {n} + 1 END)) AS {c}_lo",
                 f"array_min(transform({c}_conds, x -> CASE WHEN x.operator IN ('EQUALS', 'LTE') THEN {n} WHEN x.operator = 'LT' THEN {n} - 1 END)) AS {c}_hi",
                 f"array_distinct(transform(filter({c}_conds, x -> x.operator = 'NOT_EQUALS'), x -> x.ival)) AS {c}_ne"]
    return g.selectExpr(*cols)


def normalize_segments(segments: DataFrame, collation: str | None = None) -> DataFrame:
    """``normalize_texts`` joined back: one row per segment."""
    texts = normalize_texts(segments, collation)
    return segments.select("segment_id", "conditions").join(texts, F.expr("conditions <=> text")).drop("conditions", "text")


def exploded_conditions(segments: DataFrame) -> DataFrame:
    """Every element of every JSON array, one row each (A2):
    ``segment_id, pos, category, operator, value``."""
    return (element_rows(segments).where(F.col("pos").isNotNull())
            .select("segment_id", "pos", "category", "operator", "value"))
