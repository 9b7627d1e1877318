"""Hard-negative mining with a GNAT-style tree of hyperplane cells.

Scores are integer inner products of quantised vectors. One more coordinate
gives every vector the same norm, so that a score window of an anchor is an
annulus of distances around it. The tree is fitted on a bounded sample: each
node has up to ``FAN`` split points, far from each other, and a vector goes to
the nearest one, down to a leaf. One pass over **all** vectors then finds, for
every node, the range of distances from each split point to each sibling's
subtree. A search leaves out the siblings whose range, seen from a split point,
can't meet the annulus; the leaves that remain are scored exactly.

Rows are stored in the order of their leaves, a hot leaf in several files.
Anchors are searched in blocks of about ``ASKS``: each block makes one pass
for its positives and one for the negatives of all its windows, in which every
task keeps the few best rows of each anchor and hands only those on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmetrics.llm.common import stored

FAN = 8                       # split points of a node
SAMPLE = 16_384               # distinct vectors (about) that the tree and the first bounds are fitted on
LEAF = 64                     # sampled vectors in a leaf
ASKS = 8_192                  # distinct anchors (about) in a block
ROWS = 16_384                 # rows aimed at in a task
TILE = 2_000_000              # scores that a task holds at once
SLACK = 1e-6                  # of distances on the unit sphere, for rounding
NONE = -(1 << 62)             # below every score


class Tree:
    """Split points on the unit sphere; children are nodes (their number) or leaves (-1 - number)."""

    def __init__(self, sample: np.ndarray, scale: float, seed: int = 11):
        self.scale, self.points, self.children, self.paths = scale, [], [], []
        self.low = self.high = None
        g = np.random.default_rng(seed)
        v = self.lifted(sample)
        todo: list[tuple[np.ndarray, list, int]] = [(np.arange(len(v)), [], -1)]
        while todo:
            rows, path, _ = todo.pop()
            split = self._split(v[rows], g) if len(rows) > LEAF else None
            here = len(self.points) if split is not None else -1 - len(self.paths)
            if path:
                self.children[path[-1][0]][path[-1][1]] = here
            if split is None:
                self.paths.append(path)
                continue
            self.points.append(split)
            self.children.append([0] * len(split))
            near = np.argmax(v[rows] @ split.T, 1)
            todo += [(rows[near == j], [*path, (here, j)], here) for j in range(len(split))]

    @staticmethod
    def _split(v: np.ndarray, g: np.random.Generator) -> np.ndarray | None:
        """Up to FAN of the vectors, each the farthest of some candidates from those before; None if all are equal."""
        some = v[g.choice(len(v), min(len(v), 6 * FAN), replace=False)]
        far, chosen = np.full(len(some), 4.0), [int(g.integers(len(some)))]
        while len(chosen) < FAN:
            far = np.minimum(far, 2 - 2 * some @ some[chosen[-1]])
            if far.max() < 1e-9:
                break
            chosen.append(int(np.argmax(far)))
        return some[chosen] if len(chosen) > 1 else None

    def lifted(self, z: np.ndarray) -> np.ndarray:
        u = z / self.scale
        return np.concatenate((u, np.sqrt(np.maximum(0, 1 - (u * u).sum(1, keepdims=True)))), 1)

    def descend(self, v: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Node, rows that reach it, their distances to its split points and the child of each."""
        todo = [(0, np.arange(len(v)))] if self.points and len(v) else []
        while todo:
            node, rows = todo.pop()
            dot = v[rows] @ self.points[node].T
            near = np.argmax(dot, 1)
            yield node, rows, np.sqrt(np.maximum(0, 2 - 2 * dot)), near
            for j, c in enumerate(self.children[node]):
                if c >= 0 and (near == j).any():
                    todo.append((c, rows[near == j]))

    def leaves(self, z: np.ndarray) -> np.ndarray:
        out = np.zeros(len(z), np.int32)
        for node, rows, _, near in self.descend(self.lifted(z)):
            child = np.array(self.children[node])[near]
            out[rows[child < 0]] = -1 - child[child < 0]
        return out

    def reach(self, z: np.ndarray) -> list[np.ndarray]:
        """Distances of anchors (whose own lift is left out: it plays no part in scores) to all split points."""
        u = z / self.scale
        own = (u * u).sum(1, keepdims=True)
        return [np.sqrt(np.maximum(0, own + 1 - 2 * u @ p[:, :-1].T)) for p in self.points]

    def keeps(self, leaf: int, reach: list[np.ndarray], near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Anchors of which the leaf may hold rows at a distance near..far (anchors x windows; nan: no window)."""
        alive = ~np.isnan(near)
        for node, j in self.paths[leaf]:
            for i in range(len(self.points[node])):
                lo, hi = self.low[node, i, j], self.high[node, i, j]
                d = reach[node][:, i:i + 1]
                alive &= (d - hi <= far + SLACK) & (lo - d <= far + SLACK) & (d + hi >= near - SLACK)
        return alive.any(1)

    def annulus(self, z: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """The distance at which a row has this score (anchors x windows)."""
        u = z / self.scale
        return np.sqrt(np.maximum(0, (u * u).sum(1, keepdims=True) + 1 - 2 * scores / self.scale / self.scale))


def _matrix(packed: list[bytes], dims: int) -> np.ndarray:
    """Packed vectors as rows of whole numbers, shorter ones filled up with zeros."""
    out = np.zeros((len(packed), dims), np.int64)
    for i, p in enumerate(packed):
        x = np.frombuffer(p, "<i4")
        out[i, :len(x)] = x
    return out


def _scores(a: np.ndarray, b: np.ndarray, scale: float) -> np.ndarray:
    """Exact inner products: doubles hold every partial sum below 2^53."""
    if scale * scale < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _quantised(df: DataFrame, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """``id, label, vec`` (packed floor(256 x)) of the rows that take part."""
    def pack(batches):
        for batch in batches:
            keep, out = [], []
            for i, (row, lab, v) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if row is None or lab is None or v is None or any(x is None for x in v):
                    continue
                x = np.asarray(v, float)
                if not np.isfinite(x).all():
                    continue
                z = np.floor(256 * x)
                if len(z) and (np.abs(z).max() >= 2**31 or float(z @ z) >= 2**62):
                    continue
                z = z.astype("<i4")
                keep.append(i)
                out.append((z[:np.flatnonzero(z)[-1] + 1] if z.any() else z[:0]).tobytes())
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], names=["id", "label", "vec"])

    return df.select(F.col(id_col).cast("long"), label.cast("long"), F.col(vec_col).cast("array<double>")).mapInArrow(
        pack, "id long, label long, vec binary")


def _distinct(rows: DataFrame, n_ids: int) -> DataFrame:
    """``label, vec, ids, rep, norm``: each (label, vector) once with its smallest ids; tasks reduce their rows first."""
    def reduce(batches):
        for batch in batches:
            ids: dict[tuple, list[int]] = {}
            for i, lab, v in zip(*(batch.column(c).to_pylist() for c in range(3))):
                ids.setdefault((lab, v), []).append(i)
            norms = [float((x := np.frombuffer(v, "<i4").astype(float)) @ x) for _, v in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in ids], pa.int64()), pa.array([k[1] for k in ids], pa.binary()),
                 pa.array([sorted(set(x))[:n_ids] for x in ids.values()], pa.list_(pa.int64())), pa.array(norms, pa.float64())],
                names=["label", "vec", "ids", "norm"])

    some = rows.mapInArrow(reduce, "label long, vec binary, ids array<long>, norm double")
    salted = some.groupBy("label", "vec", F.pmod(F.spark_partition_id(), F.lit(64)).alias("salt")).agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, n_ids).alias("ids"), F.first("norm").alias("norm"))
    every = salted.groupBy("label", "vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, n_ids).alias("ids"), F.first("norm").alias("norm"))
    return every.withColumn("rep", F.col("ids")[0])


class Best:
    """The ``n`` best rows of each slot (an anchor's window): largest score, ties to the smaller id."""

    def __init__(self, slots: int, n: int):
        self.n, self.slot, self.score, self.rep, self.ids, self.held = n, [], [], [], [], 0
        self.bar = np.full(slots, NONE, np.int64)              # the n-th best score so far

    def add(self, slot, score, rep, ids) -> None:
        self.slot.append(slot), self.score.append(score), self.rep.append(rep), self.ids.append(ids)
        self.held += len(slot)
        if self.held > 200_000 + 2 * self.n * len(self.bar):
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        parts = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((self.slot, int), (self.score, np.int64), (self.rep, np.int64), (self.ids, object))]
        order = np.lexsort((parts[2], -parts[1], parts[0]))
        parts = [x[order] for x in parts]
        first = np.searchsorted(parts[0], parts[0], "left")
        place = np.arange(len(first)) - first
        nth = place == self.n - 1
        self.bar[parts[0][nth]] = parts[1][nth]
        parts = [x[place < self.n] for x in parts]
        self.slot, self.score, self.rep, self.ids = ([x] for x in parts)
        self.held = len(parts[0])
        return tuple(parts)


FOUND = "slot long, score long, ids array<long>"


def _search(rows: DataFrame, tree: Tree, asks: list, low: np.ndarray, high: np.ndarray, dims: int, n: int, same: bool) -> DataFrame:
    """``slot, score, ids``: each task's ``n`` best rows of every anchor and window (slot: anchor * windows + window).

    A row counts if its label is the anchor's (``same``) or another, and its
    score is within low..high (anchors x windows; high below NONE: no window).
    """
    packed, labels = [r.vec for r in asks], np.array([r.label for r in asks], np.int64)
    windows = low.shape[1]

    def scan(batches):
        z = _matrix(packed, dims)
        reach = tree.reach(z)
        absent = high <= NONE
        near, far = tree.annulus(z, high.astype(float)), tree.annulus(z, low.astype(float))
        near[absent] = np.nan
        best, kept = Best(len(z) * windows, n), {}
        for batch in batches:
            leaf, reps, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1, 2))
            ids = batch.column(4).to_numpy(zero_copy_only=False)
            v = _matrix(batch.column(3).to_pylist(), dims)
            order = np.argsort(leaf, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1) if len(order) else []:
                x = int(leaf[at[0]])
                if x not in kept:
                    kept[x] = np.flatnonzero(tree.keeps(x, reach, near, far))
                step = max(1, TILE // len(at)) if len(at) else 1
                for lo in range(0, len(kept[x]), step):
                    a = kept[x][lo:lo + step]
                    s = _scores(z[a], v[at], tree.scale)
                    fits = (labels[a][:, None] == own[at][None, :]) == same
                    for w in range(windows):
                        slot = a * windows + w
                        hit = fits & (s <= high[a, w][:, None]) & (s >= np.maximum(low[a, w], best.bar[slot])[:, None])
                        i, j = np.nonzero(hit)
                        if len(i):
                            best.add(slot[i], s[i, j], reps[at[j]], ids[at[j]])
        slot, score, _, ids = best.cut()
        for lo in range(0, len(slot), 10_000):
            part = slice(lo, lo + 10_000)
            yield pa.RecordBatch.from_arrays([pa.array(slot[part], pa.int64()), pa.array(score[part], pa.int64()),
                                              pa.array(list(ids[part]), pa.list_(pa.int64()))], names=["slot", "score", "ids"])

    return rows.select("leaf", "rep", "label", "vec", "ids").mapInArrow(scan, FOUND)


def _first(found: DataFrame, n: int) -> DataFrame:
    """``slot, place, id, score``: the first ``n`` rows of each slot over all tasks."""
    each = found.select("slot", "score", F.explode("ids").alias("id"))
    place = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "id"))
    return each.withColumn("place", place).filter(F.col("place") <= n)


def _windows(asks: DataFrame, sample: tuple, dims: int, scale: float, n: int, share: tuple[int, int] | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score of each window (asks x ``most``; high NONE: no window) from ``ask, label, vec, scores``.

    Without ``share`` one window of all scores, of the anchor's label; else one
    below each of the scores, of other labels. The low end is raised to the
    score that ``n`` sampled rows of the window reach: they are rows of the table.
    """
    v, own = sample

    def raise_low(batches):
        for batch in batches:
            z, labels = _matrix(batch.column(2).to_pylist(), dims), batch.column(1).to_numpy(zero_copy_only=False)
            low, high = np.full((len(z), most), NONE), np.full((len(z), most), NONE)
            for i, scores in enumerate(batch.column(3).to_pylist()):
                high[i, :len(scores)] = scores
                if share:
                    low[i, :len(scores)] = [-(-share[0] * s // share[1]) for s in scores]
            step = max(1, TILE // max(1, len(v)))
            for lo in range(0, len(z) if len(v) >= n else 0, step):
                part = slice(lo, lo + step)
                s = _scores(z[part], v, scale)
                fits = (labels[part][:, None] == own[None, :]) == (share is None)
                for w in range(most):
                    inside = np.where(fits & (s <= high[part, w][:, None]), s, NONE)
                    low[part, w] = np.maximum(low[part, w], np.partition(inside, len(v) - n, 1)[:, len(v) - n])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(low), pa.list_(pa.int64())), pa.array(list(high), pa.list_(pa.int64()))],
                                             names=["ask", "low", "high"])

    made = asks.select("ask", "label", "vec", "scores").mapInArrow(raise_low, "ask long, low array<long>, high array<long>").collect()
    low, high = (np.full((1 + max((r.ask for r in made), default=-1), most), NONE) for _ in range(2))
    for r in made:
        low[r.ask], high[r.ask] = r.low, r.high
    return low, high


def _with_ranges(tree: Tree, every: DataFrame, dims: int) -> Tree:
    """The ranges of distances from each split point to each sibling's subtree, over all vectors (a few numbers for each node reach the driver)."""
    shape = (len(tree.points), FAN, FAN)

    def ranges(batches):
        low, high = np.full(shape, np.inf), np.full(shape, -np.inf)
        for batch in batches:
            for node, _, d, near in tree.descend(tree.lifted(_matrix(batch.column(0).to_pylist(), dims))):
                for j in np.unique(near):
                    own = d[near == j]
                    k = own.shape[1]
                    low[node, :k, j] = np.minimum(low[node, :k, j], own.min(0))
                    high[node, :k, j] = np.maximum(high[node, :k, j], own.max(0))
        at = np.argwhere(np.isfinite(low))
        yield pa.RecordBatch.from_arrays([*(pa.array(at[:, c], pa.int32()) for c in range(3)), pa.array(low[tuple(at.T)]), pa.array(high[tuple(at.T)])],
                                         names=["node", "i", "j", "low", "high"])

    tree.low, tree.high = np.full(shape, np.inf), np.full(shape, -np.inf)
    for r in every.select("vec").mapInArrow(ranges, "node int, i int, j int, low double, high double").groupBy("node", "i", "j").agg(
            F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.low[r.node, r.i, r.j], tree.high[r.node, r.i, r.j] = r.low, r.high
    return tree


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(df: DataFrame, every_nth: int = 100, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), id_col: str = "vec_id",
         vec_col: str = "embedding", label: Column | None = None, asks_block: int = ASKS, sample_size: int = SAMPLE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors: rows whose id is divisible by ``every_nth``. A score is the inner
    product of the vectors of floor(256 x); higher ones come first, ties by the
    smaller id. An anchor's positives are its first rows of its own label; of
    each positive, the first rows of other labels are returned whose score s
    meets share[0] * positive <= share[1] * s <= share[1] * positive.

    Rows with a null id, label or vector, a null or non-finite component, or a
    squared norm of 2^62 or more (scores would not fit a long) take no part.
    Empty and zero vectors do, missing components count as zero. Rows that
    share id, label and vector count once. A pair without a negative gives no
    row; an empty table gives no rows. Other columns are not read.
    """
    spark = df.sparkSession
    rows = _quantised(df, id_col, vec_col, F.col("label") if label is None else label)
    keep = max(positives + 1, negatives)
    every = stored(_distinct(rows, keep))
    n, dims, norm = every.agg(F.count("*"), F.max(F.octet_length("vec")), F.max("norm")).first()
    if not n:
        return spark.createDataFrame([], OUT)
    dims, scale = dims // 4 or 1, max(1.0, float(norm) ** 0.5 * (1 + 1e-12))
    cut = min(1 << 30, -(-sample_size * (1 << 30) // n))
    picked = every.filter(F.pmod(F.xxhash64("rep", "label"), F.lit(1 << 30)) < cut).select("label", "vec").collect()
    sample = _matrix([r.vec for r in picked], dims), np.array([r.label for r in picked], np.int64)
    tree = _with_ranges(Tree(sample[0].astype(float), scale), every, dims)

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tree.leaves(_matrix(batch.column(2).to_pylist(), dims)), pa.int32()), *batch.columns],
                                             names=["leaf", "rep", "label", "vec", "ids"])

    placed = every.select("rep", "label", "vec", "ids").mapInArrow(place, "leaf int, rep long, label long, vec binary, ids array<long>")
    placed = stored(placed.repartitionByRange(-(-n // ROWS), "leaf", "rep").sortWithinPartitions("leaf", "rep"))
    anchors = rows.filter(F.col("id") % every_nth == 0).dropDuplicates(["id", "label", "vec"]).join(every.select("label", "vec", "rep"), ["label", "vec"])
    anchors = stored(anchors.select("id", F.col("rep").alias("q"), "label", "vec"))
    distinct = anchors.select("q", "label", "vec").dropDuplicates(["q", "label", "vec"])
    blocks = -(-distinct.count() // asks_block)
    results = []
    for b in range(blocks):
        asks = distinct.filter(F.pmod(F.xxhash64("q", "label", "vec"), F.lit(blocks)) == b).collect()
        if asks:
            results.append(_block(spark, placed, tree, asks, sample, dims, positives, negatives, share))
    if not results:
        return spark.createDataFrame([], OUT)
    found, picks = results[0]
    for f, p in results[1:]:
        found, picks = found.unionByName(f), picks.unionByName(p)
    own = anchors.select(F.col("id").alias("anchor_id"), "q", "label", "vec").join(found, ["q", "label", "vec"]).filter(F.col("id") != F.col("anchor_id"))
    nth = F.row_number().over(Window.partitionBy("anchor_id", "q", "label", "vec").orderBy(F.desc("positive_score"), "id"))
    own = own.withColumn("nth", nth).filter(F.col("nth") <= positives)
    out = own.join(picks, ["q", "label", "vec", "positive_score"])
    return out.select("anchor_id", F.col("id").alias("positive_id"), F.col("place").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _block(spark, placed: DataFrame, tree: Tree, asks: list, sample: tuple, dims: int, positives: int, negatives: int, share: tuple[int, int]):
    """Of a block of anchors: (``q, label, vec, id, positive_score``; ``q, label, vec, positive_score, place, negative_id, negative_score``)."""
    m = positives + 1                                          # an anchor may stand among its own first rows
    names = spark.createDataFrame([(i, r.q, r.label, bytes(r.vec)) for i, r in enumerate(asks)], "ask long, q long, label long, vec binary")
    names = names.repartition(-(-len(asks) // 256))
    low, high = _windows(names.withColumn("scores", F.array(F.lit(np.iinfo(np.int64).max))), sample, dims, tree.scale, m, None, 1)
    firsts = stored(_first(_search(placed, tree, asks, low, high, dims, m, True), m))
    scores = firsts.groupBy(F.col("slot").alias("ask")).agg(F.array_sort(F.collect_set("score")).alias("scores"))
    low, high = _windows(names.join(scores, "ask"), sample, dims, tree.scale, negatives, share, m)
    near = stored(_first(_search(placed, tree, asks, low, high, dims, negatives, False), negatives))
    found = names.join(firsts.select(F.col("slot").alias("ask"), "id", F.col("score").alias("positive_score")), "ask").drop("ask")
    picks = near.join(spark.createDataFrame([(i * m + w, i, int(high[i, w])) for i, w in np.argwhere(high > NONE).tolist()], "slot long, ask long, positive_score long"), "slot")
    picks = picks.select("ask", "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "positive_score")
    return found, names.join(picks, "ask").drop("ask")
