"""Segment-table maintenance (I8, H8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S


def touch_updated(old: DataFrame, new: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Upsert ``new`` definitions onto ``old`` by ``segment_id``.  A changed
    definition gets ``updated_at = as_of`` (ON UPDATE CURRENT_TIMESTAMP); an
    unchanged one keeps its timestamps; a new id is inserted at ``as_of``;
    ids only in ``old`` stay.  One full outer join, shuffled by segment id."""
    ts = S.ntz_literal(as_of)
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col("o.segment_id") == F.col("n.segment_id"), "full_outer")
    in_old, in_new = F.col("o.segment_id").isNotNull(), F.col("n.segment_id").isNotNull()
    changed = in_new & (~in_old | ~F.col("o.conditions").eqNullSafe(F.col("n.conditions")))
    return j.select(
        F.coalesce("n.segment_id", "o.segment_id").alias("segment_id"),
        F.when(in_new, F.col("n.conditions")).otherwise(F.col("o.conditions")).alias("conditions"),
        F.when(in_old, F.col("o.created_at")).otherwise(ts).alias("created_at"),
        F.when(changed, ts).otherwise(F.col("o.updated_at")).alias("updated_at"),
        changed.alias("changed"))


def segment_page(segments: DataFrame, after: int | None, size: int, total: int | None = None) -> DataFrame:
    """The ``size`` segments with the smallest ids above ``after`` (null:
    the first page), each with ``total`` (all segments) and ``has_next``.  The
    key set needs no growing offset: a page reads ids above a bound, and one id
    more tells whether there is a next page.  The total is counted, or taken
    from the caller who has it from the page before.  A page behind the last id
    is one row without a segment that still has the facts."""
    rest = segments if after is None else segments.where(F.col("segment_id") > after)
    some = rest.select("segment_id", "conditions").orderBy("segment_id").limit(size + 1)
    place = F.row_number().over(Window.orderBy("segment_id"))             # of size + 1 rows
    page = some.withColumn("place", place).withColumn("more", F.count(F.lit(1)).over(Window.partitionBy()) > size)
    facts = segments.agg(F.count(F.lit(1)).alias("total")) if total is None else segments.sparkSession.range(1).select(F.lit(total).cast("long").alias("total"))
    return (facts.withColumn("k", F.lit(1)).join(page.where(F.col("place") <= size).withColumn("k", F.lit(1)), "k", "left")
            .select("segment_id", "conditions", "total", F.coalesce("more", F.lit(False)).alias("has_next")))
