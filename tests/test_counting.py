"""Counting: keyed plan (S2) == nested loop (S1) == one count per segment."""

import json
import random

from hypothesis import given, settings, strategies as st

from segmetrics.operators import counting
from segmetrics.sources import derived as D

from conftest import SF001
from nested import nested_counts

ACCOUNTS = [
    (1, "a", "MALE", 20, "NATION_1", 0),
    (2, "b", "FEMALE", 35, "NATION_12", 5),
    (3, "c", "OTHER", 99, "NATION_2", 500),
    (4, "d", "MALE", 14, "nation_1", 10),
    (5, "e", "FEMALE", 30, "Nátion_3", 1),
    (6, "f", "MALE", 30, "NATION_3", 3),
    (7, "g", "FEMALE", 61, "NATION_1%", 11),
]
ACCOUNT_SCHEMA = "user_id long, name string, gender string, age int, location string, order_count int"

CATS = {"location": ["NATION_1", "NATION_3", "TION_1", "N", "nation_1", "%", "NATION_12"],
        "gender": ["MALE", "FEMALE", "male", "OTHER", "X"],
        "age": ["14", "20", "30", "35", "99", "2147483647", "-3"],
        "order_count": ["0", "1", "5", "10", "500"]}
OPS = {"location": ["EQUALS", "NOT_EQUALS", "CONTAINS", "STARTS_WITH"],
       "gender": ["EQUALS", "NOT_EQUALS", "CONTAINS", "STARTS_WITH"],
       "age": ["EQUALS", "NOT_EQUALS", "GT", "GTE", "LT", "LTE"],
       "order_count": ["EQUALS", "NOT_EQUALS", "GT", "GTE", "LT", "LTE"]}


def random_segment(rng):
    conds = []
    for _ in range(rng.randint(0, 5)):
        cat = rng.choice(list(CATS))
        conds.append({"category": cat, "operator": rng.choice(OPS[cat]),
                      "value": rng.choice(CATS[cat])})
    return conds


def brute(conds, collation=None):
    """Reference semantics in plain Python."""
    def ok(a, cnd):
        col = {"location": a[4], "gender": a[2], "age": a[3], "order_count": a[5]}[cnd["category"]]
        op, v = cnd["operator"], cnd["value"]
        if cnd["category"] in ("age", "order_count"):
            v = int(v)
            return {"EQUALS": col == v, "NOT_EQUALS": col != v, "GT": col > v,
                    "GTE": col >= v, "LT": col < v, "LTE": col <= v}[op]
        x, p = (col.lower(), v.lower()) if collation else (col, v)
        return {"EQUALS": x == p, "NOT_EQUALS": x != p, "CONTAINS": p in x,
                "STARTS_WITH": x.startswith(p)}[op]
    return sum(all(ok(a, cnd) for cnd in conds) for a in ACCOUNTS)


def _segments(spark, lists):
    return spark.createDataFrame([(i, json.dumps(l)) for i, l in enumerate(lists)],
                                 "segment_id long, conditions string")


def test_keyed_equals_nested_equals_brute(spark):
    rng = random.Random(7)
    lists = [random_segment(rng) for _ in range(150)]
    acc = spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA)
    segs = _segments(spark, lists)
    keyed = {r.segment_id: r.user_count for r in counting.count_segments(acc, segs).collect()}
    nested = {k: v for k, (v, _) in nested_counts(acc, segs).items()}
    assert keyed == nested
    for i, l in enumerate(lists):
        assert keyed[i] == brute(l), (l, keyed[i], brute(l))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(list(CATS)), st.integers(0, 5), st.integers(0, 6)),
                max_size=4))
def test_property_single_segment(spark, picks):
    conds = []
    for cat, o, v in picks:
        conds.append({"category": cat, "operator": OPS[cat][o % len(OPS[cat])],
                      "value": CATS[cat][v % len(CATS[cat])]})
    acc = spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA)
    got = counting.count_segments(acc, _segments(spark, [conds])).first().user_count
    assert got == brute(conds)
    assert counting.count_one(acc, conds).first().user_count == brute(conds)


def test_collation_ci_ai(spark):
    acc = spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA)
    lists = [[{"category": "gender", "operator": "EQUALS", "value": "male"}],
             [{"category": "location", "operator": "STARTS_WITH", "value": "nation_1"}],
             [{"category": "location", "operator": "NOT_EQUALS", "value": "nation_1"},
              {"category": "location", "operator": "NOT_EQUALS", "value": "NATION_1"}],
             [{"category": "location", "operator": "EQUALS", "value": "nation_3"}]]
    segs = _segments(spark, lists)
    got = {r.segment_id: r.user_count
           for r in counting.count_segments(acc, segs, collation="UNICODE_CI_AI").collect()}
    binary = {r.segment_id: r.user_count for r in counting.count_segments(acc, segs).collect()}
    assert binary[0] == 0 and got[0] == 3              # MALE matches male only with CI
    assert got[1] == 4 and binary[1] == 1              # NATION_1, NATION_12, nation_1, NATION_1%
    assert got[2] == 5                                 # duplicates under CI subtracted once
    assert got[3] == 2                                 # Nátion_3 too, accents ignored
    nested = {k: v for k, (v, _) in nested_counts(acc, segs, "UNICODE_CI_AI").items()}
    assert nested == got


def test_literal_wildcards_and_zero_rows(spark):
    acc = spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA)
    lists = [[{"category": "location", "operator": "CONTAINS", "value": "%"}],
             [{"category": "location", "operator": "CONTAINS", "value": "_"}],
             [{"category": "age", "operator": "LT", "value": "14"}],
             [{"category": "age", "operator": "GT", "value": "2147483647"}]]
    got = {r.segment_id: r.user_count
           for r in counting.count_segments(acc, _segments(spark, lists)).collect()}
    assert got == {0: 1, 1: 7, 2: 0, 3: 0}


def test_workload_keyed_equals_nested_sf0001(spark):
    acc = D.accounts(spark, SF001)
    segs = D.workload_segments(spark, SF001)
    k = {r.segment_id: (r.user_count, r.error_reason)
         for r in counting.count_segments(acc, segs).collect()}
    assert k == nested_counts(acc, segs) and len(k) == 300


def test_keyed_plan_has_no_nested_loop(spark):
    acc = D.accounts(spark, SF001)
    df = counting.count_segments(acc, D.workload_segments(spark, SF001))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_extreme_ages_keep_the_plan(spark):
    """A dirty age changes counts only: the plan has the same operators."""
    rng = random.Random(11)
    lists = [random_segment(rng) for _ in range(60)] + [
        [{"category": "age", "operator": "LTE", "value": "-2147483648"}], [{"category": "age", "operator": "GT", "value": "-2147483648"}],
        [{"category": "age", "operator": "EQUALS", "value": "2147483647"}, {"category": "order_count", "operator": "GTE", "value": "-2147483648"}],
        [{"category": "age", "operator": "NOT_EQUALS", "value": "2147483647"}, {"category": "order_count", "operator": "LT", "value": "2147483647"}]]
    segs = _segments(spark, lists)
    dirty = ACCOUNTS + [(8, "h", "MALE", -2**31, "NATION_1", 2**31 - 1), (9, "i", "OTHER", 2**31 - 1, "NATION_3", -2**31)]

    def shape(rows):
        df = counting.count_segments(spark.createDataFrame(rows, ACCOUNT_SCHEMA), segs)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        names = [w for w in plan.replace("+-", " ").replace(":-", " ").split() if w in ("Join", "Aggregate", "Window", "Generate", "Union")]
        return df, names
    clean_df, clean = shape(ACCOUNTS)
    df, names = shape(dirty)
    assert names == clean
    got = {r.segment_id: r.user_count for r in df.collect()}
    assert got == {k: v for k, (v, _) in nested_counts(spark.createDataFrame(dirty, ACCOUNT_SCHEMA), segs).items()}


def test_two_string_columns_under_a_collation(spark):
    rng = random.Random(5)
    lists = []
    for _ in range(120):
        lists.append([{"category": c, "operator": rng.choice(OPS[c]), "value": rng.choice(CATS[c])}
                      for c in ["location", "gender"] for _ in range(rng.randint(1, 2))]
                     + ([{"category": "age", "operator": "GTE", "value": "30"}] if rng.random() < 0.5 else []))
    acc = spark.createDataFrame([a for a in ACCOUNTS if a[4].isascii()] + [(8, "h", "Male", 30, "nation_12", 4)], ACCOUNT_SCHEMA)
    got = {r.segment_id: r.user_count for r in counting.count_segments(acc, _segments(spark, lists), collation="UNICODE_CI_AI").collect()}
    rows = [a for a in ACCOUNTS if a[4].isascii()] + [(8, "h", "Male", 30, "nation_12", 4)]

    def count(conds):
        global ACCOUNTS
        old, ACCOUNTS = ACCOUNTS, rows
        try:
            return brute(conds, "UNICODE_CI_AI")
        finally:
            ACCOUNTS = old
    assert got == {i: count(x) for i, x in enumerate(lists)}


def test_definitions_of_one_key_are_spread(spark):
    """Order-count-only definitions share a key; their positions fall into many blocks."""
    from pyspark.sql import functions as F

    from segmetrics.functions import conditions as C

    lists = [[{"category": "order_count", "operator": "GTE", "value": str(i)}] for i in range(2000)]
    acc = spark.createDataFrame([(i, "n", "MALE", 30, "X", i) for i in range(0, 4000, 3)], ACCOUNT_SCHEMA)
    segs = _segments(spark, lists)
    got = {r.segment_id: r.user_count for r in counting.count_segments(acc, segs).collect()}
    assert got == {i: sum(x >= i for x in range(0, 4000, 3)) for i in range(2000)}
    norm = C.normalize_texts(segs).withColumn("def_key", F.col("text"))
    terms = counting.segment_terms(norm, counting.account_cells(acc))
    assert terms.select(*counting.KEY).distinct().count() == 1
    assert terms.select(F.shiftright("pos", counting.BLOCK_BITS)).distinct().count() >= 8


def test_filters_reach_the_scan(spark, tmp_out):
    path = f"{tmp_out}/accounts"
    spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA).write.parquet(path)
    acc = spark.read.parquet(path)
    for cat, value in (("location", "NATION_1"), ("age", "30")):
        for op in OPS[cat]:
            df = acc.where(counting.predicate([{"category": cat, "operator": op, "value": value}]))
            plan = df._jdf.queryExecution().executedPlan().toString()
            pushed = plan.split("PushedFilters: [")[1].split("]")[0]
            assert pushed.replace(f"IsNotNull({cat})", "").strip(", "), (op, pushed)


def test_empty_inputs(spark):
    acc = spark.createDataFrame([], ACCOUNT_SCHEMA)
    lists = [[], [{"category": "age", "operator": "GTE", "value": "20"}],
             [{"category": "location", "operator": "CONTAINS", "value": "N"}]]
    got = {r.segment_id: r.user_count
           for r in counting.count_segments(acc, _segments(spark, lists)).collect()}
    assert got == {0: 0, 1: 0, 2: 0}
    full = spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA)
    none = spark.createDataFrame([], "segment_id long, conditions string")
    assert counting.count_segments(full, none).count() == 0


def test_null_account_values_never_match_conditions(spark):
    rows = ACCOUNTS + [(8, "h", None, 30, None, None), (9, "i", "MALE", 40, None, 3)]
    acc = spark.createDataFrame(rows, ACCOUNT_SCHEMA)
    lists = [[{"category": "location", "operator": "NOT_EQUALS", "value": "NATION_1"}],
             [{"category": "gender", "operator": "NOT_EQUALS", "value": "FEMALE"},
              {"category": "location", "operator": "NOT_EQUALS", "value": "NATION_3"}],
             [{"category": "order_count", "operator": "LTE", "value": "100"}],
             [{"category": "order_count", "operator": "NOT_EQUALS", "value": "5"}],
             [{"category": "age", "operator": "GTE", "value": "30"}],
             []]

    def ok(a, cnd):
        col = {"location": a[4], "gender": a[2], "age": a[3], "order_count": a[5]}[cnd["category"]]
        if col is None:
            return False
        v = cnd["value"]
        if cnd["category"] in ("age", "order_count"):
            v = int(v)
        return {"EQUALS": col == v, "NOT_EQUALS": col != v, "LTE": col <= v,
                "GTE": col >= v}[cnd["operator"]]
    want = {i: sum(all(ok(a, c) for c in l) for a in rows) for i, l in enumerate(lists)}
    segs = _segments(spark, lists)
    keyed = {r.segment_id: r.user_count for r in counting.count_segments(acc, segs).collect()}
    nested = {k: v for k, (v, _) in nested_counts(acc, segs).items()}
    assert keyed == want and nested == want


def test_collated_lookup_by_elements(spark):
    """The index of collated values finds what testing every value finds; its rows are linear in the values' length."""
    import unicodedata

    from pyspark.sql import functions as F

    texts = ["Nátion_3", "straße", "STRASSE", "strasse_s", "ﬁnal ﬂow", "final flow", "가나다", "x\xadyz", "XYZ", "เกม", "กเม", "㎏ m", "KG M", "ø o", "Æx", "aex",
             "ﬃ", "ffi", "100%", "a_b", "e", "é", "ﷺ", "naïve café", "ｆｕｌｌ", "İi", "ǅ", "dž", "あア", "½", "1⁄2", "𝔄b"]
    texts = sorted({*texts, *(unicodedata.normalize("NFD", t) for t in texts), *(unicodedata.normalize("NFKD", t) for t in texts)})
    patterns = sorted({p for t in texts for p in (t, t[:1], t[:2], t[-2:], t[1:3], t[1:])} - {""} | {"́", "ss", "SS", "s", "i", "ĳ"})
    values = spark.createDataFrame([("location", t) for t in texts], "col string, value string")
    asked = spark.createDataFrame([("location", op, p) for p in patterns for op in ("CONTAINS", "STARTS_WITH")], "col string, op string, pattern string")
    name = "UNICODE_CI_AI"
    got = {tuple(r) for r in counting.value_index(values, asked, name).select("op", "pattern", "value").collect()}
    v, p = F.collate("value", name), F.collate("pattern", name)
    every = asked.drop("col").crossJoin(values.drop("col")).where(F.when(F.col("op") == "CONTAINS", F.contains(v, p)).otherwise(F.startswith(v, p)))
    want = {tuple(r) for r in every.select("op", "pattern", "value").collect()}
    assert got == want and ("CONTAINS", "ss", "straße") in got and ("STARTS_WITH", "é", "e") in got
    assert counting.value_pieces(values, name).count() <= sum(3 * len(t) + 2 for t in texts)
    long = spark.createDataFrame([("location", "ab" * 5000)], "col string, value string")
    assert counting.value_pieces(long, name).count() <= 8


def test_cells_emit_one_row_for_each_level_in_use(spark):
    """Clean ages use few levels of the age nodes; the bit set of those in use bounds what a cell emits."""
    from segmetrics.functions import conditions as C
    cells = counting.account_cells(spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA))
    lists = [[{"category": "age", "operator": "GTE", "value": "18"}, {"category": "age", "operator": "LT", "value": "62"}], [{"category": "age", "operator": "GTE", "value": "35"}]]
    texts = C.normalize_texts(_segments(spark, lists)).withColumnRenamed("text", "def_key")
    terms = counting.segment_terms(texts, cells)
    used = {r.node // 2**33 for r in terms.where("node IS NOT NULL").select("node").collect()}
    assert used and max(used) <= 6
    bits = sum(1 << n for n in used)
    plan = counting.keyed_cells(cells, terms, bits)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 32" not in plan.split("Join")[1]
    every = {tuple(r) for r in counting.keyed_cells(cells, terms).collect()}
    assert {tuple(r) for r in counting.keyed_cells(cells, terms, bits).collect()} == every
