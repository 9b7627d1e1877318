"""Duration statistics over any duration column.

The reference measures per-segment count durations in a metrics server; here
the same arithmetic runs as table operators:

* ``summary``            -- count, sum, mean and exact p50 / p95 / p99 (D6, D7);
* ``bucket_counts``      -- cumulative counts per upper bound ``le`` (D8);
* ``histogram_quantile`` -- quantile from cumulative buckets with linear
  interpolation inside the bucket, Prometheus-style (D9);
* ``total_quantile``     -- the same over the sum of all series;
* ``bucket_tail``        -- the last ``n`` buckets by bound (F4).

Values are assigned to buckets with an array expression per row, counted with
a map-side partial aggregate, and only the small per-bucket table is windowed
(its size is bounds x groups, independent of the data).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def default_bounds(start: float = 1.0, stop: float = 300_000.0, per_octave: int = 2):
    """Upper bounds growing by 2**(1/per_octave) from ``start`` up to ``stop``
    (1 ms .. 5 min at the default), rounded to 6 decimals, then +Inf."""
    out, i = [], 0
    while True:
        b = round(start * 2 ** (i / per_octave), 6)
        if b > stop:
            break
        out.append(b)
        i += 1
    return out + [math.inf]


def _same(left: str, right: str, by) -> Column:
    """Null-safe equality of the group columns of two aliased frames."""
    return F.expr(" AND ".join(["true", *(f"{left}.`{c}` <=> {right}.`{c}`" for c in by)]))


ACCURACY = 10_000            # of the quantile sketch: ranks are right within 1 / ACCURACY of the rows
PARTS = 1024                 # of a bracket, for the running sums


def _bracketed(df: DataFrame, value: str, qs, by, stats=()) -> tuple[DataFrame, list[str]]:
    """Values counted where a wanted rank may stand: ``by..., carried..., _pos, _sub, _v, _c``.

    A mergeable sketch gives each group two values around each rank, a few
    times its error apart (a group of fewer than ACCURACY rows is one bracket).
    The rows outside the brackets are only counted; those inside are counted by
    value. ``_pos, _sub, _v`` rises with the value. The group's number of rows
    and ``stats`` are carried along, so that the sketch is read once."""
    src = df.select(*by, F.col(value).cast("double").alias("_v"), *[F.col(c) for c in dict.fromkeys([value]) if c not in by])
    src = src.selectExpr("*", "CASE WHEN isnan(_v) THEN double('Infinity') ELSE _v END AS _f")     # NaN stands above all: in the brackets, with infinity
    ends = [max(0.0, q - 4 / ACCURACY) for q in qs] + [min(1.0, q + 4 / ACCURACY) for q in qs]
    sketch = src.groupBy(*by).agg(F.expr("count(_v) AS _n"), *stats, F.expr(f"percentile_approx(_f, array({', '.join(f'{e!r}D' for e in ends)}), {ACCURACY}) AS _e"))
    carried = [c for c in sketch.columns if c not in by and c != "_e"]

    def end(i: int) -> str:
        side = "-Infinity" if i < len(qs) else "Infinity"
        return f"CASE WHEN _n >= {ACCURACY} AND {'true' if 0 < ends[i] < 1 else 'false'} THEN _e[{i}] ELSE double('{side}') END AS e{i}"
    sketch = sketch.selectExpr(*[f"`{c}`" for c in [*by, *carried]], *[end(i) for i in range(len(ends))])
    rows = src.alias("r").join(sketch.alias("s"), _same("r", "s", by)).select("r.*", *[f"s.{c}" for c in carried], *[f"s.e{i}" for i in range(len(ends))])
    pairs = [(f"e{i}", f"e{i + len(qs)}") for i in range(len(qs))]
    passed = " + ".join(f"CASE WHEN _f >= {x} THEN 1 ELSE 0 END + CASE WHEN _f > {y} THEN 1 ELSE 0 END" for x, y in pairs)
    sub = " ".join(f"WHEN _f BETWEEN {x} AND {y} THEN CASE WHEN {y} - {x} < double('Infinity') AND {y} > {x} "
                   f"THEN CAST(floor((_f - {x}) / ({y} - {x}) * {PARTS}) AS BIGINT) ELSE 0L END" for x, y in pairs)
    rows = rows.selectExpr(*[f"`{c}`" for c in [*by, *carried]], f"{passed} AS _pos", f"CASE {sub} END AS _sub", "_v", "_f").selectExpr(
        *[f"`{c}`" for c in [*by, *carried]], "_pos", "_sub", "CASE WHEN _sub IS NOT NULL THEN _v END AS _v", "CASE WHEN _f IS NULL THEN 0L ELSE 1L END AS _one")
    return rows.groupBy(*by, *carried, "_pos", "_sub", "_v").agg(F.expr("sum(_one) AS _c")), carried


def _quantiles(df: DataFrame, value: str, qs, by, stats=()) -> DataFrame:
    """``by..., stats..., q, value``."""
    cells, carried = _bracketed(df, value, qs, by, stats)
    keys, names = ", ".join(f"`{c}`" for c in by), [f"`{c}`" for c in [*by, *carried]]
    ordered = cells.selectExpr("*", f"sum(_c) OVER (PARTITION BY {keys}, _pos, _sub ORDER BY _v) AS _upto")
    parts = ordered.groupBy(*by, *carried, "_pos", "_sub").agg(F.expr("max(_upto) AS _c"))             # dealt as the window's rows are
    rank = "q * (_n - 1)"
    wanted = (parts.selectExpr(*names, "_pos", "_sub", "_c", f"sum(_c) OVER (PARTITION BY {keys} ORDER BY _pos, _sub) AS _upto")
              .selectExpr("*", f"explode(array({', '.join(f'{float(q)!r}D' for q in qs)})) AS q")
              .selectExpr("*", f"explode(array(named_struct('rank', floor({rank}), 'high', false), named_struct('rank', ceil({rank}), 'high', true))) AS _w")
              .where("_n = 0 OR (_w.rank < _upto AND _w.rank >= _upto - _c)")
              .selectExpr(*names, "_pos", "_sub", "q", f"{rank} - floor({rank}) AS _part", "_w.high AS _high", "_w.rank - _upto + _c AS _rank"))
    same = _same("w", "c", [*by, "_pos", "_sub"]) & F.expr("w._rank < c._upto AND w._rank >= c._upto - c._c")
    found = wanted.alias("w").join(ordered.select(*by, "_pos", "_sub", "_v", "_c", "_upto").alias("c"), same, "left").select("w.*", "c._v")
    found = found.selectExpr(*names, "q", "_part", "_high", "CASE WHEN _v IS NULL AND _n > 0 THEN raise_error('a rank stands outside its bracket') ELSE _v END AS _v")
    agg = found.groupBy(*by, *carried, "q", "_part").agg(F.expr("max(CASE WHEN NOT _high THEN _v END) AS _lo"), F.expr("max(CASE WHEN _high THEN _v END) AS _hi"))
    return agg.selectExpr(*names, "q", "_lo + CASE WHEN _part > 0 THEN _part * (_hi - _lo) ELSE 0.0D END AS value")


def _one_group(df: DataFrame) -> DataFrame:
    """A group column that Spark does not fold to a constant: joins on it stay equi-joins."""
    return df.withColumn("_all", F.expr("spark_partition_id() < 0"))


def exact_quantiles(df: DataFrame, value: str, qs=(0.5, 0.95, 0.99), by=()) -> DataFrame:
    """Exact quantiles with linear interpolation (position ``q * (n - 1)``),
    without gathering or sorting a group in one task, in two scans.

    The first scan makes a mergeable sketch of each group, which brackets every
    wanted rank. The second counts the rows below, between and above the
    brackets, and by value only inside them (map-side combined, so a value that
    a third of the rows hold is one row per task). Running sums over parts of
    the brackets find the part of a rank, and only the values of that part are
    sorted. Groups are compared null-safe; nulls take no part, NaN stands above
    all. Returns ``(by..., q, value)``; a group without values has no row."""
    by = list(by)
    return _quantiles(df if by else _one_group(df), value, qs, by or ["_all"]).where("_n > 0").select(*by, "q", "value")


def summary(df: DataFrame, value: str, by=()) -> DataFrame:
    """Count, sum, mean (partial aggregates) and exact p50 / p95 / p99,
    in the two scans of ``exact_quantiles``. A group without values keeps its
    row (n = 0)."""
    v = F.col(value)
    keys = list(by) or ["_all"]
    src = df if by else _one_group(df)
    stats = [F.count(v).alias("n"), F.round(F.sum(v), 6).alias("total"), F.round(F.avg(v), 6).alias("mean")]
    named = ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))
    out = _quantiles(src, value, [q for q, _ in named], keys, stats).groupBy(*keys, "n", "total", "mean").agg(
        *[F.round(F.max(F.when(F.col("q") == F.lit(q), F.col("value"))), 6).alias(name)
          for q, name in named])
    return out if by else out.drop("_all")


def bucket_counts(df: DataFrame, value: str, bounds=None, by=()) -> DataFrame:
    """``(by..., le, cum_count)`` -- observations <= le, for every bound."""
    bounds = bounds or default_bounds()
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    v = F.col(value).cast("double")
    # index of the first bound >= v (0-based), as a CASE chain (compiled)
    idx = None
    for i, b in enumerate(bounds):
        idx = F.when(v <= F.lit(float(b)), F.lit(i)) if idx is None \
            else idx.when(v <= F.lit(float(b)), F.lit(i))
    idx = idx.otherwise(F.lit(len(bounds)))       # NaN: above every bound
    per_bucket = (df.where(v.isNotNull())
                  .select(*by, idx.alias("idx"))
                  .groupBy(*by, "idx").agg(F.count(F.lit(1)).alias("n")))
    grid = (df.select(*by).distinct() if by else df.sparkSession.range(1).select())
    grid = grid.select(*by, F.posexplode(arr).alias("idx", "le"))
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("idx") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = grid.alias("g").join(per_bucket.alias("p"), _same("g", "p", [*by, "idx"]), "left").select("g.*", "p.n")
    return counted.select(*by, "le", F.sum(F.coalesce("n", F.lit(0))).over(w).cast("long").alias("cum_count"))


def histogram_quantile(buckets: DataFrame, qs=(0.5, 0.95, 0.99), by=()) -> DataFrame:
    """``(by..., q, value)`` from cumulative buckets (le, cum_count).
    rank = q * total; first bucket with cum >= rank; interpolate between the
    previous bound (0 for the first bucket) and this one; the +Inf bucket
    returns the highest finite bound."""
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("le")
    total_w = Window.partitionBy(*by) if by else Window.partitionBy()
    b = buckets.select(
        *by, "le", "cum_count",
        F.coalesce(F.lag("le").over(w), F.lit(0.0)).alias("prev_le"),
        F.coalesce(F.lag("cum_count").over(w), F.lit(0)).alias("prev_cum"),
        F.max("cum_count").over(total_w).alias("total"),
        F.max(F.when(F.col("le") != F.lit(math.inf), F.col("le"))).over(total_w)
        .alias("max_finite"))
    # each bucket row once per requested quantile (an array literal, no join)
    x = b.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))) \
        .withColumn("rank", F.col("q") * F.col("total"))
    hit = x.where(F.col("cum_count") >= F.col("rank"))
    first = Window.partitionBy(*by, "q").orderBy("le")
    pick = hit.withColumn("r", F.row_number().over(first)).where(F.col("r") == 1)
    interp = F.col("prev_le") + (F.col("le") - F.col("prev_le")) * \
        (F.col("rank") - F.col("prev_cum")) / (F.col("cum_count") - F.col("prev_cum"))
    val = (F.when(F.col("total") == 0, F.lit(float("nan")))
           .when(F.col("le") == F.lit(math.inf), F.col("max_finite"))
           .when(F.col("cum_count") == F.col("prev_cum"), F.col("le"))
           .otherwise(interp))
    return pick.select(*by, "q", F.round(val, 6).alias("value"))


def total_quantile(buckets: DataFrame, qs=(0.5, 0.95, 0.99)) -> DataFrame:
    """D9 over all series: cumulative counts summed by bound, then the quantiles."""
    total = buckets.groupBy("le").agg(F.sum("cum_count").cast("long").alias("cum_count"))
    return histogram_quantile(total, qs)


def bucket_tail(buckets: DataFrame, n: int = 25) -> DataFrame:
    """cumulative counts summed over series, last ``n`` bounds."""
    return (buckets.groupBy("le").agg(F.sum("cum_count").cast("long").alias("cum_count"))
            .orderBy(F.col("le").desc()).limit(n))
