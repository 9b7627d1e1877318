"""Approximate nearest neighbours by inner product with multiprobe p-stable hashing.

Equal vectors become one row with their smallest ids. Vectors are scaled into
the unit ball and get one more coordinate that completes their norm, so that a
larger inner product is a smaller distance. Each of ``TABLES`` tables hashes a
vector to a bucket of ``k`` quantised random projections; a query visits the
``probes`` buckets of each table that are likeliest to hold its neighbours, in
the order of the squared distances to the cell walls. Buckets are dealt into
shards, large shards are split; every shard ranks the candidates by exact inner
products and the shards' best are merged.

``k`` follows the number of vectors; ``probes`` is the smallest number that
finds ``TARGET`` of the true neighbours of ``SAMPLE`` queries, whose neighbours
are found by one exact pass over all vectors. That number serves most queries,
not those that lie apart: a query is unsure if it found too few vectors, or if
a vector as far away as its last one is met by the probes with a probability
below ``SURE``. Unsure queries are searched again, exactly, in blocks of
``BLOCK`` queries against all vectors.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from segmetrics.llm.common import stored

TABLES = 8
WIDTH = 2.0                   # of a cell, in standard deviations of a projection
BUCKET = 8                    # vectors aimed at in a bucket
SHARD = 4096                  # vectors aimed at in a shard
TOP = "q long, reps array<long>, scores array<double>"
SAMPLE = 64                   # queries for choosing the number of probes
TARGET = 0.96
MAX_MOVES = 20_000            # perturbations that are ordered for each query and table; what lies beyond makes a query unsure
SURE = 0.85                   # probability with which the last neighbour's distance is to be met
DRAWS = 300                   # of that probability's estimate, for each distance
BLOCK = 4096                  # unsure queries of one exact pass
TILE = 2_000_000              # scores that a task holds at once


def _dense(rows: list[bytes], dims: int) -> np.ndarray:
    """Packed vectors as a matrix of doubles, shorter ones filled up with zeros."""
    out = np.zeros((len(rows), dims))
    for i, r in enumerate(rows):
        x = np.frombuffer(r, "<f8")
        out[i, :len(x)] = x
    return out


class Index:
    """The hash functions; ``scale`` is the largest norm."""

    def __init__(self, dims: int, scale: float, k: int, seed: int = 5):
        g = np.random.default_rng(seed)
        self.dims, self.scale, self.k = dims, scale, k
        self.a = g.normal(size=(TABLES, dims + 1, k))
        self.b = g.uniform(0, WIDTH, (TABLES, k))
        self.code = g.integers(1, 2**63, k, dtype=np.int64).astype(np.uint64) | np.uint64(1)
        most = 0
        while most < k and sum(math.comb(k, j) * 2**j for j in range(most + 2)) <= MAX_MOVES:
            most += 1
        moves = []
        for j in range(most + 1):
            for where in itertools.combinations(range(k), j):
                for signs in itertools.product((-1, 1), repeat=j):
                    m = [0] * k
                    for i, s in zip(where, signs):
                        m[i] = s
                    moves.append(m)
        self.moves = np.array(moves, np.int64)

    def places(self, v: np.ndarray, query: bool, t: int) -> np.ndarray:
        """Projections in units of the cell width."""
        if query:
            x = np.concatenate((v / np.linalg.norm(v, axis=1, keepdims=True), np.zeros((len(v), 1))), 1)
        else:
            u = v / self.scale
            x = np.concatenate((u, np.sqrt(np.maximum(0, 1 - (u * u).sum(1, keepdims=True)))), 1)
        return (x @ self.a[t] + self.b[t]) / WIDTH

    def buckets(self, cells: np.ndarray) -> np.ndarray:
        """A 64-bit number for each row of cells."""
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64).astype(np.uint64) * self.code).sum(1, dtype=np.uint64)

    def probes(self, v: np.ndarray, t: int, count: int) -> np.ndarray:
        """Buckets (queries x count) in the order of estimated success."""
        at = self.places(v, True, t)
        cell = np.floor(at)
        up, down = (1 - (at - cell)) ** 2, (at - cell) ** 2
        cost = up @ (self.moves == 1).T + down @ (self.moves == -1).T
        count = min(count, len(self.moves))
        if count < len(self.moves):
            near = np.argpartition(cost, count - 1, axis=1)[:, :count]
        else:
            near = np.broadcast_to(np.arange(count), cost.shape)
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(cost, near, 1), 1, kind="stable"), 1)
        return np.stack([self.buckets(cell.astype(np.int64) + self.moves[near[:, j]]) for j in range(count)], 1)


def met(index: Index, count: int, distances: np.ndarray, seed: int = 3) -> np.ndarray:
    """The probability that a vector at such a distance of a query stands in one of its ``count`` probed buckets of some table.

    Projections of p-stable functions differ by a normal variable times the
    distance, whatever the data are, so the probes of random places tell it.
    """
    g = np.random.default_rng(seed)
    at = g.uniform(size=(DRAWS, index.k))
    up, down = (1 - at) ** 2, at ** 2
    cost = np.sort(up @ (index.moves == 1).T + down @ (index.moves == -1).T, 1)
    last = cost[:, min(count, cost.shape[1]) - 1]                       # the dearest probe of each place
    shift = g.normal(size=(DRAWS, index.k))
    out = []
    for d in distances:
        move = np.floor(at + shift * d / WIDTH)
        spent = (up * (move == 1) + down * (move == -1)).sum(1)
        out.append(((np.abs(move) <= 1).all(1) & (spent <= last + 1e-12) & ((move != 0).sum(1) <= (index.moves != 0).sum(1).max())).mean())
    return 1 - (1 - np.array(out)) ** TABLES


def _exact(every: DataFrame, asked: list, dims: int, n: int) -> DataFrame:
    """``q, reps, scores``: each task's ``n`` best vectors of a block of queries."""
    reps, packed = np.array([r.rep for r in asked]), [r.vec for r in asked]

    def scan(batches):
        qv = _dense(packed, dims)
        best: list = [(np.zeros(0, np.int64), np.zeros(0))] * len(reps)
        bar = np.full(len(reps), -np.inf)                               # the n-th best score so far
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            step = max(1, TILE // len(reps))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                s, ids = qv @ _dense(part.column(1).to_pylist(), dims).T, own[lo:lo + step]
                for i in np.flatnonzero((s >= bar[:, None]).any(1)):
                    hit = s[i] >= bar[i]
                    r, x = np.concatenate((best[i][0], ids[hit])), np.concatenate((best[i][1], s[i][hit]))
                    at = _best(x, r, n)
                    best[i] = r[at], x[at]
                    if len(at) == n:
                        bar[i] = x[at[-1]]
        yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array([b[0] for b in best], pa.list_(pa.int64())), pa.array([b[1] for b in best], pa.list_(pa.float64()))],
                                         names=["q", "reps", "scores"])

    return every.select("rep", "vec").mapInArrow(scan, TOP)


def _unsure(best: DataFrame, queries: DataFrame, index: Index, count: int, n: int, n_vectors: int) -> DataFrame:
    """``rep, vec`` of the queries that found fewer than ``n`` vectors (and not all there are), or whose last one is too far away to be sure of."""
    grid = np.linspace(0.02, 2.0, 100)
    sure = met(index, count, grid)
    far = float(grid[:int(np.argmax(sure < SURE))][-1]) if (sure < SURE).any() and sure[0] >= SURE else (0.0 if sure[0] < SURE else 2.0)

    def lowest(vec: bytes) -> float:
        """The score of a vector of the largest norm at the distance ``far`` of a query."""
        return float(np.linalg.norm(np.frombuffer(vec, "<f8"))) * index.scale * (1 - far * far / 2)

    def judge(batches):
        for batch in batches:
            want = min(n, n_vectors)
            bad = [i for i, (vec, s) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
                   if s is None or len(s) < want or min(s) < lowest(vec)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(bad, pa.int64())), batch.column(1).take(pa.array(bad, pa.int64()))], names=["rep", "vec"])

    return queries.join(best.select(F.col("q").alias("rep"), "scores"), "rep", "left").select("rep", "vec", "scores").mapInArrow(judge, "rep long, vec binary")


def _valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (packed doubles) of the vectors that take part."""
    def pack(batches):
        for batch in batches:
            ids, out = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is None or not v or any(x is None for x in v):
                    continue
                x = np.asarray(v, "<f8")
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    out.append((x + 0.0).tobytes())                 # -0.0 and 0.0 are the same vector
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["id", "vec"])

    return df.select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>")).mapInArrow(pack, "id long, vec binary")


def _distinct(rows: DataFrame, n_ids: int) -> DataFrame:
    """``vec, rep, ids, norm``: each vector once, with its ``n_ids`` smallest ids; tasks reduce their rows first."""
    def reduce(batches):
        for batch in batches:
            ids: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.setdefault(v, []).append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(ids), pa.binary()), pa.array([sorted(set(x))[:n_ids] for x in ids.values()], pa.list_(pa.int64())),
                 pa.array([float(np.linalg.norm(np.frombuffer(v, "<f8"))) for v in ids], pa.float64()),
                 pa.array([len(v) // 8 for v in ids], pa.int32())], names=["vec", "ids", "norm", "dims"])

    some = rows.mapInArrow(reduce, "vec binary, ids array<long>, norm double, dims int")
    every = some.groupBy("vec").agg(F.collect_list("ids").alias("ids"), F.first("norm").alias("norm"), F.first("dims").alias("dims"))
    return every.withColumn("ids", F.slice(F.array_sort(F.array_distinct(F.flatten("ids"))), 1, n_ids)).withColumn("rep", F.col("ids")[0])


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n largest scores, ties to the smaller id."""
    if len(scores) > 4 * n:
        cut = np.partition(scores, len(scores) - n)[len(scores) - n]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:n]]




def _merged(top: DataFrame, n: int, groups: int) -> DataFrame:
    """The n best representatives of each query out of all its lists."""
    def merge(key, pdf):
        import pandas as pd

        out = []
        for q, part in pdf.groupby("q", sort=False):
            reps, scores = np.concatenate(list(part["reps"])), np.concatenate(list(part["scores"]))
            reps, first = np.unique(reps, return_index=True)
            at = _best(scores[first], reps, n)
            out.append((q, reps[at], scores[first][at]))
        return pd.DataFrame(out, columns=["q", "reps", "scores"])

    return top.groupBy(F.pmod(F.xxhash64("q"), F.lit(groups)).alias("g")).applyInPandas(merge, TOP)


def _exact_top(every: DataFrame, sample: list, dims: int, n: int) -> dict[int, list[int]]:
    """True neighbours of a few queries, by one pass over all vectors."""
    qv, qi = _dense([r.vec for r in sample], dims), np.array([r.rep for r in sample])

    def scan(batches):
        for batch in batches:
            reps, v = batch.column(0).to_numpy(zero_copy_only=False), _dense(batch.column(1).to_pylist(), dims)
            s = qv @ v.T
            at = [_best(s[i], reps, n) for i in range(len(qi))]
            yield pa.RecordBatch.from_arrays([pa.array(qi), pa.array([reps[x] for x in at], pa.list_(pa.int64())),
                                              pa.array([s[i][x] for i, x in enumerate(at)], pa.list_(pa.float64()))], names=["q", "reps", "scores"])

    return {r.q: list(r.reps) for r in _merged(every.select("rep", "vec").mapInArrow(scan, TOP), n, len(qi)).collect()}


def _choose(every: DataFrame, queries: DataFrame, dims: int, scale: float, n_vectors: int, n: int) -> tuple[Index, int]:
    """The index and its number of probes, from the true neighbours of a bounded sample."""
    sample = queries.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).collect()
    truth = _exact_top(every, sample, dims, n + 1)
    wanted = sorted({x for xs in truth.values() for x in xs})                       # at most SAMPLE * (n + 1)
    vectors = {r.rep: r.vec for r in every.join(F.broadcast(every.sparkSession.createDataFrame([(x,) for x in wanted], "rep long")), "rep")
               .select("rep", "vec").collect()}
    pos = {x: i for i, x in enumerate(wanted)}
    v, qv = _dense([vectors[x] for x in wanted], dims), _dense([r.vec for r in sample], dims)
    for k in range(min(16, max(1, round(math.log(max(2, n_vectors / BUCKET)) / math.log(2.77)))), 0, -1):
        index = Index(dims, scale, k)
        count = 4
        found = [np.floor(index.places(v, False, t)) for t in range(TABLES)]
        mine = [index.buckets(x) for x in found]
        probes = [index.probes(qv, t, len(index.moves)) for t in range(TABLES)]
        rank = []
        for i, r in enumerate(sample):
            at = [pos[x] for x in truth[r.rep] if x != r.rep][:n]
            for j in at:
                rank.append(min((int(np.argmax(hit)) if (hit := probes[t][i] == mine[t][j]).any() else 1 << 40) for t in range(TABLES)))
        rank = np.sort(rank)
        if not len(rank):
            return index, count
        need = rank[min(len(rank) - 1, math.ceil(TARGET * len(rank)) - 1)]
        if need < 1 << 40:
            return index, max(count, int(need) + 1)
    return index, len(index.moves)


def nearest(df: DataFrame, every_nth: int = 20, n: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``n`` nearest found of each vector whose id is divisible by ``every_nth``.

    The probes find at least nine in ten of the true ones overall, and queries
    that the probes serve badly are searched exactly.
    Nearest first by inner product in double precision on the given vectors,
    ties to the smaller id, the query's own row left out. Null ids and vectors
    that are null, empty, zero or hold null or non-finite components take no
    part; vectors of fewer dimensions count as filled up with zeros; rows that
    share id and vector count once. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = _valid(df, id_col, vec_col)
    every = stored(_distinct(rows, n + 1))
    n_vectors, dims, scale = every.agg(F.count("*"), F.max("dims"), F.max("norm")).first()
    asked = rows.filter(F.col("id") % every_nth == 0).dropDuplicates(["id", "vec"]).join(every.select("vec", "rep"), "vec").select("id", "rep", "vec")
    asked = stored(asked)
    queries = asked.dropDuplicates(["rep"]).select("rep", "vec")
    schema = "query_id long, rank int, vec_id long, score double"
    if not n_vectors:
        return spark.createDataFrame([], schema)
    index, count = _choose(every, queries, dims, scale, n_vectors, n)
    shards = max(1, -(-n_vectors // SHARD))
    k = index.k
    m = n + 1

    def member(batches):
        index = Index(dims, scale, k)
        for batch in batches:
            v = _dense(batch.column(1).to_pylist(), dims)
            for t in range(TABLES):
                b = index.buckets(np.floor(index.places(v, False, t)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), t), pa.int32()), pa.array((b % np.uint64(shards)).astype(np.int64)), pa.array(b.view(np.int64)),
                     batch.column(0), batch.column(1)], names=["t", "s", "b", "rep", "vec"])

    def ask(batches):
        index = Index(dims, scale, k)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                v = _dense(part.column(1).to_pylist(), dims)
                for t in range(TABLES):
                    b = index.probes(v, t, count)
                    s = (b % np.uint64(shards)).astype(np.int64)
                    row, to, which = [], [], []
                    for i in range(len(v)):
                        order = np.argsort(s[i], kind="stable")
                        for x in np.split(order, np.flatnonzero(np.diff(s[i][order])) + 1):
                            row.append(i)
                            to.append(int(s[i][x[0]]))
                            which.append(b[i][x].tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), t), pa.int32()), pa.array(to, pa.int64()), pa.array(which, pa.binary()),
                         part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))], names=["t", "s", "bs", "q", "vec"])

    members = every.select("rep", "vec").mapInArrow(member, "t int, s long, b long, rep long, vec binary")
    parts = members.groupBy("t", "s").agg(F.ceil(F.count("*") / (2 * SHARD)).cast("int").alias("parts"))
    held_parts = stored(parts)
    members = members.join(held_parts, ["t", "s"]).withColumn("part", F.pmod(F.xxhash64("rep"), "parts")).select("t", "s", "b", "rep", "vec", "part")
    asks = (queries.select("rep", "vec").mapInArrow(ask, "t int, s long, bs binary, q long, vec binary").join(held_parts.select(F.col("t").alias("pt"), F.col("s").alias("ps"), F.col("parts").alias("n_parts")), (F.col("t") == F.col("pt")) & (F.col("s") == F.col("ps")))
            .select("t", "s", "bs", "q", "vec", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts").cast("long") - 1)).alias("part")))

    def rank(key, own, asking):
        import pandas as pd

        if not len(own) or not len(asking):
            return pd.DataFrame({"q": [], "reps": [], "scores": []})
        own = own.sort_values("b")
        b, reps, v = own["b"].to_numpy().view(np.uint64), own["rep"].to_numpy(), _dense(list(own["vec"]), dims)
        order = np.argsort(b, kind="stable")
        b, reps, v = b[order], reps[order], v[order]
        out = []
        for q, qv, bs in zip(asking["q"].to_numpy(), _dense(list(asking["vec"]), dims), asking["bs"]):
            want = np.frombuffer(bs, "<u8")
            lo, hi = np.searchsorted(b, want, "left"), np.searchsorted(b, want, "right")
            if not (hi > lo).any():
                continue
            at = np.concatenate([np.arange(x, y) for x, y in zip(lo, hi) if y > x])
            score = v[at] @ qv
            best = _best(score, reps[at], m)
            out.append((q, reps[at][best], score[best]))
        return pd.DataFrame(out, columns=["q", "reps", "scores"])

    top = members.groupBy("t", "s", "part").cogroup(asks.groupBy("t", "s", "part")).applyInPandas(rank, TOP)
    best = stored(_merged(top, m, max(1, shards)))
    again = stored(_unsure(best, queries, index, count, m, n_vectors))
    blocks = -(-again.count() // BLOCK)
    exact = None
    for b in range(blocks):
        block = again.filter(F.pmod(F.xxhash64("rep"), F.lit(blocks)) == b).collect()
        if block:
            more = stored(_merged(_exact(every, block, dims, m), m, max(1, shards)))
            exact = more if exact is None else exact.unionByName(more)
    if exact is not None:
        best = best.join(again.select(F.col("rep").alias("q")), "q", "left_anti").unionByName(exact)
    found = (best.select("q", F.explode(F.arrays_zip("reps", "scores")).alias("x")).select("q", F.col("x.reps").alias("rep"), F.col("x.scores").alias("score"))
             .join(every.select("rep", "ids"), "rep").select("q", F.explode("ids").alias("vec_id"), "score"))
    pairs = asked.select(F.col("id").alias("query_id"), F.col("rep").alias("q")).join(found, "q").filter(F.col("vec_id") != F.col("query_id"))
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", place.alias("rank"), "vec_id", "score").filter(F.col("rank") <= n).select("query_id", "rank", "vec_id", "score")
