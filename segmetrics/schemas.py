"""Schemas and the fixed vocabulary of segment conditions."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal the reference's for the same results.
# Condition categories, operator names, statuses and supported operators.
# ---------------------------------------------------------------------------
STRING_CATEGORIES = ("location", "gender")
NUMBER_CATEGORIES = ("age", "order_count")
KNOWN_CATEGORIES = STRING_CATEGORIES + NUMBER_CATEGORIES

OPERATORS = (
    "GT", "GTE", "EQUALS", "LTE", "LT",
    "NOT_EQUALS", "CONTAINS", "STARTS_WITH", "ENDS_WITH",
)
STRING_OPERATORS = ("EQUALS", "NOT_EQUALS", "CONTAINS", "STARTS_WITH")
NUMBER_OPERATORS = ("EQUALS", "NOT_EQUALS", "GT", "GTE", "LT", "LTE")

PENDING, COUNTED, INSERTED = "PENDING", "COUNTED", "INSERTED"
STATUSES = (PENDING, COUNTED, INSERTED)

# Error reasons written to ``segment_errors`` (our names).
INVALID_JSON = "invalid_json"
NOT_ARRAY = "not_array"
INVALID_CONDITION = "invalid_condition"
UNKNOWN_OPERATOR = "unknown_operator"
NULL_CONDITION = "null_condition"
NULL_CATEGORY = "null_category"
NULL_OPERATOR = "null_operator"
INVALID_NUMBER = "invalid_number"
UNSUPPORTED_OPERATOR = "unsupported_operator"
SEGMENT_MISSING = "segment_missing"

# Bit of each column in a segment *signature* (the set of columns its
# effective conditions touch).  The order matches ``cube(location, gender,
# age, order_count)`` so that ``signature == 15 - grouping_id()``.
CATEGORY_BITS = {"location": 8, "gender": 4, "age": 2, "order_count": 1}
ALL_BITS = 15

# Characters for which Java's Character.isWhitespace is true; a value
# "has text" when it holds any other character.  Written as a regex class
# that both Java regex (Spark) and RE2 (DuckDB) read the same way.
JAVA_WHITESPACE_CLASS = (
    "\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{1680}\\x{2000}-\\x{2006}"
    "\\x{2008}-\\x{200A}\\x{2028}\\x{2029}\\x{205F}\\x{3000}"
)
HAS_TEXT_PATTERN = "[^" + JAVA_WHITESPACE_CLASS + "]"
# Integer.parseInt accepts an optional sign and ASCII digits, nothing else.
STRICT_INT_PATTERN = "^[+-]?[0-9]+$"

LONG_MIN = -(2 ** 63)
LONG_MAX = 2 ** 63 - 1

ACCOUNT = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("gender", T.StringType(), False),
    T.StructField("age", T.IntegerType(), False),
    T.StructField("location", T.StringType(), False),
    T.StructField("order_count", T.IntegerType(), False),
])

# CSV layout of the account seed file: no header, no user_id.
ACCOUNT_CSV = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("order_count", T.IntegerType(), True),
])

SEGMENT = T.StructType([
    T.StructField("segment_id", T.LongType(), False),
    T.StructField("conditions", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
])

METRIC = T.StructType([
    T.StructField("segment_id", T.LongType(), False),
    T.StructField("metric_date", T.DateType(), False),
    T.StructField("user_count", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
])

# A stored row of a day: its count, its status and, if it could not be counted, why.
STORED_DAY = "segment_id long, user_count long, status string, error_reason string, metric_date date"
STORED_MONTH = f"{STORED_DAY}, month string"

CONDITION = T.StructType([
    T.StructField("category", T.StringType(), True),
    T.StructField("operator", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])


def ntz_literal(value):
    """A TIMESTAMP_NTZ literal for a naive datetime (wall-clock, no zone)."""
    from pyspark.sql import functions as F
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
