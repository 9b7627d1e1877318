"""Validation and normalization of condition lists."""

import json

import pytest

from segmetrics import schemas as S
from segmetrics.functions import conditions as C
from segmetrics.operators import counting


def c(cat, op, val):
    return {"category": cat, "operator": op, "value": val}


CASES = [
    # (conditions text, expected error or None)
    (json.dumps([c("location", "EQUALS", "NATION_3")]), None),
    (None, None),
    ("[]", None),
    ("null", None),
    (json.dumps([c("age", "GTE", "   ")]), None),
    (json.dumps([c("country", "EQUALS", "KR")]), None),
    (json.dumps([c("Age", "GTE", "20")]), None),
    (json.dumps([c("location", "ENDS_WITH", "3")]), S.UNSUPPORTED_OPERATOR),
    (json.dumps([c("gender", "GT", "MALE")]), S.UNSUPPORTED_OPERATOR),
    (json.dumps([c("age", "CONTAINS", "3")]), S.UNSUPPORTED_OPERATOR),
    (json.dumps([c("age", "GTE", " 5 ")]), S.INVALID_NUMBER),
    (json.dumps([c("age", "GTE", "2147483648")]), S.INVALID_NUMBER),
    (json.dumps([c("age", "GTE", "5.0")]), S.INVALID_NUMBER),
    (json.dumps([c("age", "CONTAINS", "abc")]), S.INVALID_NUMBER),
    (json.dumps([c("age", None, "5")]), S.NULL_OPERATOR),
    ("{bad", S.INVALID_JSON),
    ("", S.INVALID_JSON),
    (json.dumps([c("age", "BETWEEN", "5")]), S.UNKNOWN_OPERATOR),
    (json.dumps([c("age", "BETWEEN", " ")]), S.UNKNOWN_OPERATOR),
    (json.dumps(c("age", "GTE", "20")), S.NOT_ARRAY),
    ('"text"', S.NOT_ARRAY),
    ("[null]", S.NULL_CONDITION),
    (json.dumps([c(None, "EQUALS", "x")]), S.NULL_CATEGORY),
    ("[5]", S.INVALID_CONDITION),
    # first failing condition in list order wins
    (json.dumps([c("gender", "GT", "M"), c("age", "GTE", "x")]), S.UNSUPPORTED_OPERATOR),
    (json.dumps([c("age", "GTE", "x"), c("gender", "GT", "M")]), S.INVALID_NUMBER),
    # load-level problems beat per-condition ones
    (json.dumps([c("age", "GTE", "x"), c("age", "NEAR", "1")]), S.UNKNOWN_OPERATOR),
    (json.dumps([c("age", "GTE", "+5"), c("age", "LT", "007")]), None),
    ('[{"category":"age","operator":"GTE","value":20}]', None),
]


def test_error_reasons(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "segment_id long, conditions string")
    got = {r.segment_id: r.error_reason
           for r in C.normalize_segments(df).select("segment_id", "error_reason").collect()}
    for i, (text, want) in enumerate(CASES):
        assert got[i] == want, (text, got[i], want)


def test_normalized_bounds_and_signature(spark):
    conds = [c("age", "GTE", "20"), c("age", "LT", "30"), c("age", "GT", "2147483647"),
             c("order_count", "NOT_EQUALS", "3"), c("gender", "EQUALS", "MALE"),
             c("location", "STARTS_WITH", "N"), c("location", "NOT_EQUALS", "NATION_1")]
    df = spark.createDataFrame([(1, json.dumps(conds))], "segment_id long, conditions string")
    r = C.normalize_segments(df).first()
    assert r.error_reason is None
    assert r.signature == 15
    assert r.age_lo == 2147483648 and r.age_hi == 29
    assert r.order_count_ne == [3]
    assert r.gender_mode == "eq" and r.gender_eq == "MALE"
    assert r.location_mode == "scan" and r.location_drv_op == "STARTS_WITH"
    assert r.location_ne == ["NATION_1"]


def test_blank_value_skipped_before_category(spark):
    text = json.dumps([c(None, "EQUALS", " "), c("gender", "EQUALS", "")])
    df = spark.createDataFrame([(1, text)], "segment_id long, conditions string")
    r = C.normalize_segments(df).first()
    assert r.error_reason is None and r.signature == 0


def test_java_whitespace_is_not_text(spark):
    text = json.dumps([c("age", "GTE", " \u000b\u001c")])  # em space, VT, FS
    df = spark.createDataFrame([(1, text)], "segment_id long, conditions string")
    assert C.normalize_segments(df).first().signature == 0
    nbsp = json.dumps([c("age", "GTE", " ")])              # no-break space is text
    df = spark.createDataFrame([(1, nbsp)], "segment_id long, conditions string")
    assert C.normalize_segments(df).first().error_reason == S.INVALID_NUMBER


def test_predicate_raises_like_reference():
    with pytest.raises(ValueError, match=S.UNSUPPORTED_OPERATOR):
        counting.predicate([c("location", "ENDS_WITH", "x")])
    with pytest.raises(ValueError, match=S.INVALID_NUMBER):
        counting.predicate([c("age", "LT", " 5")])
    with pytest.raises(ValueError, match=S.NULL_OPERATOR):
        counting.predicate([c("gender", None, "MALE")])
    with pytest.raises(ValueError, match=S.NULL_CONDITION):
        counting.predicate([None])
    counting.predicate([c("country", "GT", "x"), c("age", "GT", "  ")])


def test_exploded_conditions(spark):
    text = '[{"category":"age","operator":"GTE","value":20}, null]'
    df = spark.createDataFrame([(7, text), (8, "{bad"), (9, "[]")],
                               "segment_id long, conditions string")
    rows = C.exploded_conditions(df).orderBy("pos").collect()
    assert [(r.segment_id, r.pos, r.category, r.value) for r in rows] == \
        [(7, 0, "age", "20"), (7, 1, None, None)]
