"""Tables derived from the driver's test data (TPC-H-like parquet).

The given tables hold no ``account`` or ``segment`` table, so both are
derived here with integer arithmetic that SQL engines reproduce exactly:

* ``accounts``       -- one account per customer (FIXTURES.md section 2);
* ``seed_segments``  -- one generated segment per customer, ladder step spread
  over the 5,000-step generator, locations mapped onto ``NATION_x``;
* ``edge_segments``  -- one hand-written edge-case definition per customer
  (error paths, match-all, every operator); seed ids are odd, edge ids even;
* ``workload_segments`` -- both together;
* ``crash_day``      -- a partly processed metric day (crash recovery input),
  its state taken from the customer's market segment.

Every table grows with the customer / orders tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import seed

LADDER_STEPS = 5000
RUN_DAY = dt.date(2026, 5, 1)

# ---------------------------------------------------------------------------
# Edge-case definitions (FIXTURES.md section 3 plus a few
# combinations).  Tokens {n}, {a}, {o} are replaced per customer key k by
# k % 25, 14 + k % 86 and k % 26.  A None entry is a SQL NULL definition.
# ---------------------------------------------------------------------------
EDGE_TEMPLATES = [
    '[{"category":"location","operator":"EQUALS","value":"NATION_{n}"}]',
    '[{"category":"gender","operator":"NOT_EQUALS","value":"MALE"}]',
    '[{"category":"location","operator":"CONTAINS","value":"TION_2"}]',
    '[{"category":"location","operator":"STARTS_WITH","value":"NATION_1"}]',
    '[{"category":"age","operator":"EQUALS","value":"{a}"}]',
    '[{"category":"age","operator":"NOT_EQUALS","value":"{a}"}]',
    '[{"category":"order_count","operator":"GT","value":"{o}"}]',
    '[{"category":"age","operator":"GTE","value":"20"},{"category":"age","operator":"LT","value":"30"}]',
    '[{"category":"order_count","operator":"LTE","value":"{o}"}]',
    '[{"category":"location","operator":"EQUALS","value":"NATION_{n}"},'
    '{"category":"gender","operator":"EQUALS","value":"FEMALE"},'
    '{"category":"age","operator":"GTE","value":"30"},'
    '{"category":"order_count","operator":"GTE","value":"10"}]',
    '[{"category":"age","operator":"LT","value":"14"}]',
    '[{"category":"age","operator":"GTE","value":"50"},{"category":"age","operator":"LT","value":"20"}]',
    None,
    '[]',
    'null',
    '[{"category":"age","operator":"GTE","value":"   "}]',
    '[{"category":"country","operator":"EQUALS","value":"KR"}]',
    '[{"category":"country","operator":"GT","value":"KR"},{"category":"gender","operator":"EQUALS","value":"MALE"}]',
    '[{"category":"Age","operator":"GTE","value":"20"}]',
    '[{"category":"location","operator":"CONTAINS","value":"%"}]',
    '[{"category":"location","operator":"ENDS_WITH","value":"3"}]',
    '[{"category":"gender","operator":"GT","value":"MALE"}]',
    '[{"category":"age","operator":"CONTAINS","value":"3"}]',
    '[{"category":"age","operator":"GTE","value":" 5 "}]',
    '[{"category":"age","operator":"GTE","value":"2147483648"}]',
    '[{"category":"age","operator":"CONTAINS","value":"abc"}]',
    '[{"category":"age","operator":null,"value":"5"}]',
    '{bad',
    '[{"category":"age","operator":"BETWEEN","value":"5"}]',
    '{"category":"age","operator":"GTE","value":"20"}',
    '[{"category":"location","operator":"NOT_EQUALS","value":"NATION_{n}"},'
    '{"category":"gender","operator":"NOT_EQUALS","value":"FEMALE"},'
    '{"category":"age","operator":"GT","value":"{a}"}]',
    '[{"category":"location","operator":"STARTS_WITH","value":"NATION_1"},'
    '{"category":"location","operator":"NOT_EQUALS","value":"NATION_1{o}"},'
    '{"category":"order_count","operator":"GTE","value":"{o}"}]',
    '[{"category":"location","operator":"NOT_EQUALS","value":"NATION_1"},'
    '{"category":"location","operator":"NOT_EQUALS","value":"NATION_2"},'
    '{"category":"location","operator":"NOT_EQUALS","value":"NATION_1"}]',
    '[{"category":"age","operator":"GTE","value":20}]',
    '[null]',
    '[{"category":null,"operator":"EQUALS","value":"x"}]',
    '[{"category":"age","operator":"GT","value":"2147483647"}]',
    '[{"category":"gender","operator":"EQUALS","value":"male"}]',
    '[{"category":"gender","operator":"EQUALS","value":"   "},'
    '{"category":"location","operator":"EQUALS","value":"NATION_{n}"}]',
    '[{"category":"location","operator":"EQUALS","value":"NATION_{n}"},'
    '{"category":"location","operator":"EQUALS","value":"NATION_5"}]',
    '[{"category":"order_count","operator":"NOT_EQUALS","value":"{o}"},'
    '{"category":"order_count","operator":"NOT_EQUALS","value":"3"},'
    '{"category":"gender","operator":"NOT_EQUALS","value":"OTHER"}]',
    '[{"category":"age","operator":"GTE","value":"+20"},'
    '{"category":"order_count","operator":"LTE","value":"007"}]',
    '[{"category":"gender","operator":"NOT_EQUALS","value":"MALE"},'
    '{"category":"location","operator":"CONTAINS","value":"_1"},'
    '{"category":"location","operator":"CONTAINS","value":"N_"}]',
    '[{"category":"location","operator":"STARTS_WITH","value":"NATION_2"},'
    '{"category":"gender","operator":"NOT_EQUALS","value":"OTHER"},'
    '{"category":"order_count","operator":"NOT_EQUALS","value":"{o}"},'
    '{"category":"age","operator":"LTE","value":"{a}"}]',
    '[{"category":"age","operator":"GTE","value":20.0}]',
    '[{"category":"order_count","operator":"GTE","value":true}]',
    '[{"category":"location","operator":"EQUALS","value":{"a":1}}]',
    '[{"category":"gender","operator":"EQUALS","value":["MALE"]}]',
    '[{"category":"location","operator":"STARTS_WITH","value":"NATION_1"},'
    '{"category":"gender","operator":"CONTAINS","value":"MALE"}]',
    '[{"category":"location","operator":"CONTAINS","value":"TION_{n}"},'
    '{"category":"gender","operator":"STARTS_WITH","value":"M"},'
    '{"category":"age","operator":"LTE","value":"{a}"}]',
    '[{"category":"location","operator":"NOT_EQUALS","value":"NATION_{n}"},'
    '{"category":"gender","operator":"CONTAINS","value":"male"}]',
    '[{"category":"location","operator":"CONTAINS","value":"N_1"},'
    '{"category":"gender","operator":"STARTS_WITH","value":"FE"},'
    '{"category":"order_count","operator":"GTE","value":"{o}"},'
    '{"category":"age","operator":"NOT_EQUALS","value":"{a}"}]',
]

# Crash-recovery state of each customer's segments on RUN_DAY, by market
# segment: no row yet / PENDING / leftover COUNTED / done / orphan row.
CRASH_STATES = {"AUTOMOBILE": None, "BUILDING": S.PENDING, "FURNITURE": S.COUNTED,
                "HOUSEHOLD": S.INSERTED, "MACHINERY": "ORPHAN"}


# Columns that are read; with a schema the read needs no job of its own.
COLUMNS = {"customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", "nation": "n_nationkey int, n_name string",
           "orders": "o_custkey long", "events": "event_id long, event_type string, value double"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account per customer: location from the nation, order count from orders.
    ``orders`` is reduced to one row per customer (map-side partial count)
    before the join; ``nation`` is a tiny dimension that Spark broadcasts by
    its measured size."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_customer = (table(spark, sf_dir, "orders").groupBy("o_custkey")
                    .agg(F.count(F.lit(1)).alias("n_orders")))
    k = F.col("c_custkey")
    g = (k * 7919) % 10000
    return (customer
            .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .join(per_customer, k == per_customer.o_custkey, "left")
            .select(k.cast("long").alias("user_id"),
                    F.col("c_name").alias("name"),
                    F.when(g < 4925, "MALE").when(g < 9900, "FEMALE")
                    .otherwise("OTHER").alias("gender"),
                    (14 + (k * 31) % 86).cast("int").alias("age"),
                    F.col("n_name").alias("location"),
                    F.coalesce(F.col("n_orders"), F.lit(0)).cast("int").alias("order_count")))


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"))


def seed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated segment per customer k: id 2k+1, ladder step (7k % 5000) + 1
    (spreads customers over every ladder branch at every scale)."""
    keys = customer_keys(spark, sf_dir).select(
        (F.col("k") * 2 + 1).alias("segment_id"),
        ((F.col("k") * 7) % LADDER_STEPS + 1).alias("step"))
    return seed.generate_segments(keys, step_col="step", domain="nation")


def _edge_text(k):
    idx = (k % len(EDGE_TEMPLATES)).cast("int") + 1
    text = F.element_at(F.lit(EDGE_TEMPLATES).cast("array<string>"), idx)
    for token, value in (("{n}", k % 25), ("{a}", 14 + k % 86), ("{o}", k % 26)):
        text = F.replace(text, F.lit(token), value.cast("string"))
    return text


def edge_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    ts = S.ntz_literal(dt.datetime(2026, 5, 1))
    return customer_keys(spark, sf_dir).select(
        (k * 2 + 2).alias("segment_id"), _edge_text(k).alias("conditions"),
        ts.alias("created_at"), ts.alias("updated_at"))


def workload_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_segments(spark, sf_dir).unionByName(edge_segments(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 backfill over the workload segments (120 days each)."""
    return seed.backfill_history(workload_segments(spark, sf_dir).select("segment_id"))


def crash_day(spark: SparkSession, sf_dir: str, day: dt.date = RUN_DAY) -> DataFrame:
    """Metric rows already present for ``day`` after a simulated crash."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("long").alias("k"), "c_mktsegment")
    state = F.col("c_mktsegment")
    rows = c.select(
        F.explode(F.array(F.col("k") * 2 + 1, F.col("k") * 2 + 2)).alias("sid"),
        "k", state)
    status = (F.when(state == "BUILDING", S.PENDING)
              .when(state == "FURNITURE", S.COUNTED)
              .when(state == "HOUSEHOLD", S.INSERTED)
              .when(state == "MACHINERY", S.PENDING))
    count = (F.when(state == "FURNITURE", F.col("k") % 100)
             .when(state == "HOUSEHOLD", F.col("k") % 1000)
             .otherwise(F.lit(0)))
    sid = F.when(state == "MACHINERY", -F.col("sid")).otherwise(F.col("sid"))
    return (rows.where(status.isNotNull())
            .select(sid.alias("segment_id"), F.lit(day).alias("metric_date"),
                    count.cast("long").alias("user_count"), status.alias("status")))
