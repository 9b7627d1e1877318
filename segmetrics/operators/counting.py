"""Counting accounts per segment.

``count_segments`` answers "how many accounts satisfy every condition of each
segment" for all segments at once, with one plan for every data size:

1. ``cells``: accounts grouped by the four columns -- one scan, map-side
   partial counts, one shuffle. Its size is bounded by the product of the
   column domains, not by the number of accounts; a key holding a third of all
   accounts collapses to one row before the shuffle.
2. ``terms``: each distinct definition text becomes a few signed rows
   (weight, key, position), and its count is the sum of
   weight x P(key, position). A key fixes the two string columns (or leaves
   them open) and one *age node*; P(key, position) is the number of accounts
   of the key whose order count is at most the position.
   - EQUALS gives a string key; CONTAINS / STARTS_WITH look their values up by
     equi-joins with an index of the column's distinct values; a column with
     only NOT_EQUALS is all values minus each excluded one. Both columns go
     through the same joins.
   - An age range is the disjoint union of dyadic nodes (aligned blocks of 2^l
     ages), an excluded age is the one-age node subtracted. Ranges are cut to
     the observed ages, so clean ages use few levels, and a cell emits one row
     for each level that some term uses (a dirty age adds levels, at most 33,
     but does not change the plan).
   - An order-count range is P(hi) - P(lo - 1); an excluded value x subtracts
     P(x) - P(x - 1).
3. The nodes that some term needs are joined to the cells and counted per key
   and order count. Distinct positions are looked up by running sums in two
   levels (within blocks of 256 positions, then over the blocks of a key), so
   a key that all definitions share is spread over its blocks.
4. The answers are joined back to the terms by equality and summed; a left
   join back to all segments keeps zero counts (D2).

No join carries a broadcast hint: Spark/AQE broadcast the small sides only when
their measured size is under ``spark.sql.autoBroadcastJoinThreshold``; above it
the same plan runs as shuffle joins (AQE splits skewed partitions). The
normalized distinct texts, the cells and the terms are written to the
checkpoint folder while the result is being built: each feeds several branches.
The observed ages and the levels in use are counted by those writes
(``observe``). Expressions are SQL text: one call to the JVM each, which at
small sizes is what building such a plan costs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import conditions as C
from ..session import materialize

COLUMNS = ("location", "gender", "age", "order_count")
GRAM = 3                # pieces by which the substring index is keyed
BLOCK_BITS = 8          # order-count positions in a block: 2^8
NO_STRINGS, NO_LONGS = "CAST(array() AS ARRAY<STRING>)", "CAST(array() AS ARRAY<BIGINT>)"
KEY = ["bits", "loc", "gen", "node"]


def account_cells(accounts: DataFrame, collation: str | None = None) -> DataFrame:
    """Accounts grouped by the four condition columns (partial agg + shuffle).
    With a collation, values that it holds equal are one value."""
    if not collation:
        return accounts.groupBy(*COLUMNS).agg(F.count(F.lit(1)).alias("n"))
    same = [F.collate(F.col(c), collation).alias(f"_{c}") for c in S.STRING_CATEGORIES]
    exact = accounts.groupBy(*COLUMNS).agg(F.count(F.lit(1)).alias("n"))
    rep = {c: exact.where(F.col(c).isNotNull()).groupBy(F.collate(F.col(c), collation).alias(f"_{c}"))
           .agg(F.min(F.col(c)).alias(f"{c}_rep")) for c in S.STRING_CATEGORIES}
    out = exact.select("*", *same)
    for c in S.STRING_CATEGORIES:
        out = out.join(rep[c], f"_{c}", "left")
    return (out.groupBy(F.col("location_rep").alias("location"), F.col("gender_rep").alias("gender"), "age", "order_count")
            .agg(F.sum("n").alias("n")))


def value_index(values: DataFrame, needed: DataFrame, collation: str | None) -> DataFrame:
    """``col, op, pattern, value``: the values (``col, value``) that each needed (col, op, pattern) finds.
    A value is filed under short pieces of itself, a pattern comes in by its
    first piece, and the pair is tested; the rows of the index are linear in
    the length of the values. Without a collation the pieces are the grams of
    up to GRAM characters. With one they are up to GRAM *elements* (a base
    character with the marks that follow), compared under the collation: equal
    texts may have different lengths there, but an element equals at most GRAM
    others ("ss" and the sharp s). Characters that the collation spells out at
    greater length or reorders (UNEVEN) are filed apart: a pattern that holds
    one is tested on every value, a value that holds one for every pattern."""
    same = f"collate(_v, '{collation}') = collate(pattern, '{collation}')" if collation else "_v = pattern"
    exact = (needed.where("op = 'IS'").alias("n").join(values.selectExpr("col AS _c", "value AS _v"), F.expr(f"n.col = _c AND {same}"))
             .selectExpr("col", "op", "pattern", "_v AS value"))
    parts = needed.where("op <> 'IS'")
    if not collation:
        grams = (values.selectExpr("col", "value", "explode(sequence(1, length(value))) AS i").selectExpr("col", "value", "i", f"explode(sequence(1, {GRAM})) AS k")
                 .where("i + k - 1 <= length(value)").selectExpr("col", "value", "substring(value, i, k) AS gram").distinct())
        asked = parts.selectExpr("*", f"substring(pattern, 1, {GRAM}) AS gram")
    else:
        grams = value_pieces(values, collation)
        firsts = ", ".join(f"{_piece('e', '0', k)}" for k in range(1, GRAM + 1))
        asked = (parts.selectExpr("*", f"{_elements('pattern')} AS e").selectExpr(
            "col", "op", "pattern", f"explode(concat(array({firsts}, {_marker('uneven')}), CASE WHEN pattern RLIKE r'{UNEVEN}' THEN array({_marker('every')}) "
                                    f"ELSE CAST(array() AS {PIECES}) END)) AS g")
            .where("g.text IS NOT NULL").selectExpr("col", "op", "pattern", "g.kind", f"collate(g.text, '{collation}') AS gram"))
    v, p = ("value", "pattern") if not collation else (f"collate(value, '{collation}')", f"collate(pattern, '{collation}')")
    found = (asked.join(grams, ["col", "gram", *(["kind"] if collation else [])])
             .where(f"CASE op WHEN 'CONTAINS' THEN contains({v}, {p}) ELSE startswith({v}, {p}) END").select("col", "op", "pattern", "value"))
    return exact.unionByName(found.distinct())


# A base character with what a collation ignores after it; characters
# with long expansions (squared words, ligatures of phrases) and reordered vowels.
ELEMENT = r"[^\p{M}\p{Cc}\p{Cf}][\p{M}\p{Cc}\p{Cf}]*"
UNEVEN = r"[\x{3200}-\x{33FF}\x{FB00}-\x{FB06}\x{FDF0}-\x{FDFF}\x{0E40}-\x{0E44}\x{0EC0}-\x{0EC4}\x{19B5}-\x{19BA}\x{AAB5}-\x{AABC}\x{1F100}-\x{1F2FF}]"
PIECES = "array<struct<kind:string,text:string>>"


def _elements(text: str) -> str:
    return f"regexp_extract_all({text}, r'{ELEMENT}', 0)"


def _piece(elements: str, i: str, k: int) -> str:
    """``k`` elements from the ``i``-th (from 0) on, with a null text where there are fewer."""
    return f"named_struct('kind', 'piece', 'text', CASE WHEN size({elements}) >= {i} + {k} THEN array_join(slice({elements}, {i} + 1, {k}), '') END)"


def _marker(kind: str) -> str:
    return f"named_struct('kind', '{kind}', 'text', '')"


def value_pieces(values: DataFrame, collation: str) -> DataFrame:
    """``col, value, kind, gram``: the index of collated values, at most GRAM rows for each element and two for each value."""
    at = ", ".join(_piece("e", "i", k) for k in range(1, GRAM + 1))
    rows = values.selectExpr("col", "value", f"{_elements('value')} AS e", f"value RLIKE r'{UNEVEN}' AS uneven").selectExpr(
        "col", "value", f"explode(concat(flatten(transform(e, (x, i) -> array({at}))), array({_marker('every')}), "
                        f"CASE WHEN uneven THEN array({_marker('uneven')}) ELSE CAST(array() AS {PIECES}) END)) AS g")
    return rows.where("g.text IS NOT NULL").selectExpr("col", "value", "g.kind", f"collate(g.text, '{collation}') AS gram").distinct()


def _string_keys(defs: DataFrame, cells: DataFrame, collation: str | None) -> DataFrame:
    """``def_key, location_keys, gender_keys``: the values that a definition's EQUALS or CONTAINS /
    STARTS_WITH conditions on the column hold for, or that its NOT_EQUALS exclude."""
    def look(c: str) -> str:
        return (f"named_struct('col', '{c}', 'mode', {c}_mode, 'conds', {c}_conds, 'look', CASE {c}_mode "
                f"WHEN 'eq' THEN array(named_struct('op', 'IS', 'pattern', CAST({c}_eq AS STRING))) "
                f"WHEN 'scan' THEN array(named_struct('op', {c}_drv_op, 'pattern', CAST({c}_drv_value AS STRING))) "
                f"ELSE transform({c}_ne, x -> named_struct('op', 'IS', 'pattern', CAST(x AS STRING))) END)")
    both = ", ".join(look(c) for c in S.STRING_CATEGORIES)
    wanted = (defs.selectExpr("def_key", f"explode(array({both})) AS s").where("s.mode <> 'none'")
              .selectExpr("def_key", "s.col", "s.mode", "s.conds", "explode(s.look) AS l").selectExpr("def_key", "col", "mode", "conds", "l.op", "l.pattern"))
    columns = ", ".join(f"named_struct('col', '{c}', 'value', {c})" for c in S.STRING_CATEGORIES)
    values = cells.selectExpr(f"explode(array({columns})) AS v").where("v.value IS NOT NULL").selectExpr("v.col", "v.value").distinct()
    index = value_index(values, wanted.select("col", "op", "pattern").distinct(), collation)
    x, p = ("value", "e.value") if not collation else (f"collate(value, '{collation}')", f"collate(e.value, '{collation}')")
    holds = (f"forall(conds, e -> coalesce(CASE e.operator WHEN 'EQUALS' THEN {x} = {p} WHEN 'NOT_EQUALS' THEN {x} <> {p} "
             f"WHEN 'CONTAINS' THEN contains({x}, {p}) WHEN 'STARTS_WITH' THEN startswith({x}, {p}) END, false))")
    return (wanted.join(index, ["col", "op", "pattern"]).where(f"mode = 'ne' OR {holds}")
            .groupBy("def_key").agg(*[F.expr(f"collect_set(CASE WHEN col = '{c}' THEN value END) AS {c}_keys") for c in S.STRING_CATEGORIES]))


def _nodes_sql(lo: str, hi: str, top: int = 32) -> str:
    """Dyadic nodes of the int32 ages lo..hi (bigint expressions), as codes
    ``level * 2^33 + number``, of levels up to ``top``."""
    a, b = f"(greatest({lo}, -2147483648L) + 2147483648L)", f"(least({hi}, 2147483647L) + 2147483649L)"
    up, down = f"shiftright({a} + shiftleft(1L, l) - 1, l)", f"shiftright({b}, l)"
    return (f"filter(flatten(transform(sequence(0, {top}), l -> CASE WHEN {up} < {down} THEN array("
            f"CASE WHEN {up} % 2 = 1 THEN l * 8589934592L + {up} END, "
            f"CASE WHEN {down} % 2 = 1 THEN l * 8589934592L + {down} - 1 END) "
            f"ELSE array(CAST(NULL AS BIGINT)) END)), x -> x IS NOT NULL)")


def _string_options(c: str) -> str:
    """Signed keys of a string column: one open, one for each value, or (NOT_EQUALS only) all values
    minus each excluded one, minus NULL (SQL's <> never matches a NULL value)."""
    def opt(w, bit, key):
        return f"named_struct('w', {w}, 'bit', {bit}, 'key', CAST({key} AS STRING))"
    bit, keys = S.CATEGORY_BITS[c], f"coalesce({c}_keys, {NO_STRINGS})"
    return (f"CASE {c}_mode WHEN 'none' THEN array({opt(1, 0, 'NULL')}) "
            f"WHEN 'ne' THEN concat(array({opt(1, 0, 'NULL')}, {opt(-1, bit, 'NULL')}), transform({keys}, k -> {opt(-1, bit, 'k')})) "
            f"ELSE transform({keys}, k -> {opt(1, bit, 'k')}) END")


def segment_terms(defs: DataFrame, cells: DataFrame, collation: str | None = None, ages: tuple | None = None) -> DataFrame:
    """``def_key, w, bits, loc, gen, node, pos``: the signed lookups whose sum is
    each definition's count. ``bits``: the string columns that the key fixes
    (a fixed null is the accounts without a value); a null node is every age.
    ``ages``: least and largest observed age, to which ranges are cut (nodes
    beyond them are empty); null for a table without ages."""
    least, largest = ages if ages is not None else cells.agg(F.min("age"), F.max("age")).first()
    least, largest = (0, -1) if least is None else (least, largest)
    t = defs.join(_string_keys(defs, cells, collation), "def_key", "left").selectExpr(
        "*", f"greatest(coalesce(age_lo, {least}L), {least}L) AS age_from", f"least(coalesce(age_hi, {largest}L), {largest}L) AS age_to",
        f"coalesce(order_count_lo, -{S.LONG_MAX}L - 1L) AS order_from", f"coalesce(order_count_hi, {S.LONG_MAX}L) AS order_to")
    least_long = f"(-{S.LONG_MAX}L - 1L)"
    age = (f"CASE WHEN signature & {S.CATEGORY_BITS['age']} = 0 THEN array(named_struct('w', 1, 'node', CAST(NULL AS BIGINT))) ELSE concat("
           f"transform(CASE WHEN age_from <= age_to THEN {_nodes_sql('age_from', 'age_to', (largest - least + 1).bit_length())} ELSE {NO_LONGS} END, x -> named_struct('w', 1, 'node', x)), "
           f"transform(filter(age_ne, x -> x BETWEEN age_from AND age_to), x -> named_struct('w', -1, 'node', x + 2147483648L))) END")
    orders = (f"CASE WHEN signature & {S.CATEGORY_BITS['order_count']} = 0 THEN array(named_struct('w', 1, 'pos', {S.LONG_MAX}L)) "
              f"WHEN order_from <= order_to THEN concat(array(named_struct('w', 1, 'pos', order_to), "
              f"named_struct('w', -1, 'pos', CASE WHEN order_from > {least_long} THEN order_from - 1L ELSE {least_long} END)), "
              f"flatten(transform(filter(order_count_ne, x -> x BETWEEN order_from AND order_to), "
              f"x -> array(named_struct('w', -1, 'pos', CAST(x AS BIGINT)), named_struct('w', 1, 'pos', x - 1L))))) END")
    t = t.selectExpr("def_key", f"explode({_string_options('location')}) AS l", f"{_string_options('gender')} AS g", f"{age} AS a", f"{orders} AS o")
    t = t.selectExpr("def_key", "l", "explode(g) AS g", "a", "o").selectExpr("def_key", "l", "g", "explode(a) AS a", "o")
    t = t.selectExpr("def_key", "l", "g", "a", "explode(o) AS o")
    return t.selectExpr("def_key", "l.w * g.w * a.w * o.w AS w", "l.bit | g.bit AS bits", "l.key AS loc", "g.key AS gen", "a.node AS node", "o.pos AS pos")


def _null_safe(left: str, right: str, columns) -> Column:
    return F.expr(" AND ".join(f"{left}.{c} <=> {right}.{c}" for c in columns))


def keyed_cells(cells: DataFrame, terms: DataFrame, levels: int = (1 << 33) - 1) -> DataFrame:
    """``bits, loc, gen, node, pos, n``: accounts of each key that some term
    needs, per order count (a missing order count stands before all others).
    ``levels``: bit set of the age-node levels that the terms use."""
    used = ", ".join(f"{n}L" for n in range(33) if levels >> n & 1)
    above = f"transform(array({used}), l -> l * 8589934592L + shiftright(age + 2147483648L, CAST(l AS INT)))" if used else NO_LONGS
    nodes = cells.selectExpr("location", "gender", "order_count", "n",
                             f"explode(concat(array(CAST(NULL AS BIGINT)), CASE WHEN age IS NULL THEN {NO_LONGS} ELSE {above} END)) AS node")
    need = terms.select("bits", "node").distinct()
    kept = nodes.alias("c").join(need.alias("q"), _null_safe("c", "q", ["node"])).selectExpr("c.*", "q.bits")
    keys = [f"CASE WHEN bits & {S.CATEGORY_BITS[c]} <> 0 THEN {c} END AS {name}" for c, name in (("location", "loc"), ("gender", "gen"))]
    return (kept.selectExpr("bits", *keys, "node", f"coalesce(CAST(order_count AS BIGINT), -{S.LONG_MAX}L - 1L) AS pos", "n")
            .groupBy(*KEY, "pos").agg(F.expr("sum(n) AS n")))


def keyed_counts(texts: DataFrame, accounts: DataFrame, collation: str | None = None) -> DataFrame:
    """(def_key, user_count) for every valid definition that matches something."""
    seen = Observation()
    cells = materialize(account_cells(accounts, collation).observe(seen, F.expr("min(age) AS least"), F.expr("max(age) AS largest")))
    ages = seen.get["least"], seen.get["largest"]
    defs = texts.where("error_reason IS NULL")
    used = Observation()
    terms = materialize(segment_terms(defs, cells, collation, ages).observe(used, F.expr("bit_or(shiftleft(1L, CAST(node DIV 8589934592L AS INT))) AS levels")))
    asked = terms.select(*KEY, "pos").distinct().selectExpr("*", "CAST(NULL AS BIGINT) AS n")
    rows = keyed_cells(cells, terms, used.get["levels"] or 0).unionByName(asked).selectExpr("*", f"shiftright(pos, {BLOCK_BITS}) AS block")
    key = ", ".join(KEY)
    rows = rows.selectExpr(*KEY, "pos", "n", "block", f"sum(n) OVER (PARTITION BY {key}, block ORDER BY pos, n IS NULL ROWS UNBOUNDED PRECEDING) AS p")
    upto = rows.where("n IS NULL")
    blocks = rows.groupBy(*KEY, "block").agg(F.expr("max(p) AS n")).selectExpr(        # dealt as the window's rows are: no shuffle
        *KEY, "block", f"sum(n) OVER (PARTITION BY {key} ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead")
    found = (upto.alias("u").join(blocks.alias("b"), _null_safe("u", "b", [*KEY, "block"]))
             .selectExpr(*[f"u.{c}" for c in [*KEY, "pos"]], "coalesce(u.p, 0L) + coalesce(b.ahead, 0L) AS p").where("p > 0"))
    return (terms.alias("t").join(found.alias("f"), _null_safe("t", "f", [*KEY, "pos"]))
            .groupBy("t.def_key").agg(F.expr("CAST(sum(t.w * f.p) AS BIGINT) AS user_count")))


def count_segments(accounts: DataFrame, segments: DataFrame, collation: str | None = None) -> DataFrame:
    """C1 + D2 for all segments: ``segment_id, user_count, error_reason``.
    Invalid segments get count 0 and their reason; valid segments that match
    nothing get 0 (never null)."""
    # Each distinct text is normalized once and gets a short key that the
    # checkpoint makes stable; the texts feed several branches.
    texts = materialize(C.normalize_texts(segments, collation).withColumn("def_key", F.monotonically_increasing_id()))
    counts = texts.select("text", "error_reason", "def_key").join(keyed_counts(texts, accounts, collation), "def_key", "left")
    return (segments.select("segment_id", "conditions").join(counts, F.expr("conditions <=> text"))
            .selectExpr("segment_id", "CASE WHEN error_reason IS NULL THEN coalesce(user_count, 0L) ELSE 0L END AS user_count", "error_reason"))


# ------------------------------ one segment -------------------------------

def predicate(conditions, collation: str | None = None) -> Column:
    """B1: the AND predicate of one condition list, as a Column of bare
    comparisons that a scan can take over (a filter drops NULL).  Raises
    ``ValueError`` with the error reason on an invalid list (R5-R9)."""
    if conditions is None:
        return F.lit(True)
    preds = []
    for cond in conditions:
        if cond is None:
            raise ValueError(S.NULL_CONDITION)
        category, operator, value = (cond.get("category"), cond.get("operator"),
                                     cond.get("value"))
        if operator is not None and operator not in S.OPERATORS:
            raise ValueError(S.UNKNOWN_OPERATOR)
        if value is not None and not isinstance(value, str):
            value = str(value)
        if value is None or value.strip(_JAVA_WS) == "":
            continue
        if category is None:
            raise ValueError(S.NULL_CATEGORY)
        if category in S.STRING_CATEGORIES:
            if operator is None:
                raise ValueError(S.NULL_OPERATOR)
            if operator not in S.STRING_OPERATORS:
                raise ValueError(S.UNSUPPORTED_OPERATOR)
            preds.append(C.bare_test(operator, C.collated(F.col(category), collation),
                                     C.collated(F.lit(value), collation)))
        elif category in S.NUMBER_CATEGORIES:
            number = _parse_int(value)
            if number is None:
                raise ValueError(S.INVALID_NUMBER)
            if operator is None:
                raise ValueError(S.NULL_OPERATOR)
            if operator not in S.NUMBER_OPERATORS:
                raise ValueError(S.UNSUPPORTED_OPERATOR)
            preds.append(C.bare_test(operator, F.col(category), F.lit(number)))
    out = None
    for p in preds:
        out = p if out is None else out & p
    return F.lit(True) if out is None else out


# Characters for which Java's Character.isWhitespace is true (see schemas).
_JAVA_WS = "".join(chr(c) for c in [*range(9, 14), *range(0x1C, 0x20), 0x20, 0x1680,
                                     *range(0x2000, 0x2007), *range(0x2008, 0x200B),
                                     0x2028, 0x2029, 0x205F, 0x3000])


def _parse_int(value: str):
    if not re.fullmatch(r"[+-]?[0-9]+", value):
        return None
    n = int(value)
    return n if -(2 ** 31) <= n < 2 ** 31 else None


def count_one(accounts: DataFrame, conditions, collation: str | None = None) -> DataFrame:
    """D1 + D2: one-row DataFrame ``user_count`` for one condition list."""
    return accounts.where(predicate(conditions, collation)).agg(
        F.count(F.lit(1)).cast("long").alias("user_count"))
