"""Hard negatives against brute force: whole table, copies, ties, odd rows, pruning."""

import numpy as np
from pyspark.sql import functions as F

from segmetrics.llm import hard_negatives as H
from segmetrics.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def brute(rows, nth=100, share=(80, 100), top=5):
    """rows: (id, label, vector); the result's rows as a sorted list."""
    ok = {}
    for i, lab, v in rows:
        if i is None or lab is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        z = np.floor(256 * np.asarray(v, float)).astype(int)
        ok[i, lab, tuple(z)] = z
    ok = [(i, lab, z) for (i, lab, _), z in ok.items()]

    def score(a, b):
        n = min(len(a), len(b))
        return int(a[:n] @ b[:n])
    out = []
    for i, lab, z in ok:
        if i % nth:
            continue
        s = [(score(z, y), j, other) for j, other, y in ok if j != i]
        for ps, p, _ in sorted((x for x in s if x[2] == lab), key=lambda x: (-x[0], x[1]))[:top]:
            fits = sorted(((n, j) for n, j, other in s if other != lab and share[0] * ps <= share[1] * n <= share[1] * ps), key=lambda x: (-x[0], x[1]))
            out += [(i, p, k + 1, j, ps, n) for k, (n, j) in enumerate(fits[:top])]
    return sorted(out)


def test_whole_table_and_small_blocks(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, list(r.embedding))
            for r in spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()]
    want = brute(rows)
    assert sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, MIDDLE).collect())) == want and want
    df = spark.createDataFrame([(i, lab, v) for i, lab, v in rows], "vec_id long, label int, embedding array<double>")
    got = H.mine(df, every_nth=20, asks_block=9, sample_size=150)              # several blocks, bounds of a small sample
    assert sorted(map(tuple, got.collect())) == brute(rows, 20)


def test_copies_ties_and_odd_rows(spark):
    g = np.random.default_rng(5)
    rows = [(i, i % 3, g.integers(-3, 4, 4).tolist()) for i in range(1, 160)]            # many ties
    rows += [(i, i % 2, [1.0, 2.0, 0.5, -1.0]) for i in range(200, 420)]                 # a common vector, anchors among its copies
    rows += [(500, 1, None), (600, None, [1.0] * 4), (700, 1, [1.0, None, 0.0, 0.0]), (800, 1, [float("nan")] * 4), (900, 2, [float("inf")] * 4),
             (None, 1, [1.0] * 4), (1000, 1, []), (1100, 2, [0.0] * 4), (1200, 0, [3.0]), (1300, 0, [1e30, 0.0, 0.0, 0.0]), (100, rows[99][1], rows[99][2])]
    df = spark.createDataFrame([(i, lab, [None if x is None else float(x) for x in v] if v is not None else None, "x", 1, 2) for i, lab, v in rows],
                               "vec_id long, label int, embedding array<double>, rep string, ids int, q int")
    want = brute([r for r in rows if r[0] != 1300], 50)
    assert want and sorted(map(tuple, H.mine(df, every_nth=50).collect())) == want
    assert H.mine(df.limit(0)).count() == 0
    assert H.mine(df.filter("vec_id = 100")).count() == 0


def test_large_numbers_stay_exact(spark):
    g = np.random.default_rng(6)
    rows = [(i, i % 2, (g.normal(size=3) * 2e5).tolist()) for i in range(60)]            # squared norms above 2^53
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert sorted(map(tuple, H.mine(df, every_nth=10).collect())) == brute(rows, 10)


def test_tree_leaves_out_far_leaves_and_no_row_of_a_window(spark):
    g = np.random.default_rng(7)
    centres = g.normal(size=(40, 8)) * 4
    z = np.floor(256 * (centres[g.integers(0, 40, 4000)] + g.normal(size=(4000, 8)) * 0.05)).astype(np.int64)
    scale = float(np.sqrt((z * z).sum(1).max()))
    tree = H.Tree(z[:2000].astype(float), scale)
    df = spark.createDataFrame([(bytearray(x.astype("<i4").tobytes()),) for x in z], "vec binary")
    H._with_ranges(tree, df, 8)
    leaf, asks = tree.leaves(z), z[:50]
    s = asks @ z.T
    high = np.sort(s, 1)[:, -3][:, None]
    low = np.sort(s, 1)[:, -40][:, None]
    near, far, reach = tree.annulus(asks, high.astype(float)), tree.annulus(asks, low.astype(float)), tree.reach(asks)
    kept = 0
    for x in range(len(tree.paths)):
        alive = tree.keeps(x, reach, near, far)
        inside = ((s >= low) & (s <= high))[:, leaf == x].any(1)
        assert (alive | ~inside).all()
        kept += alive.sum()
    assert len(tree.paths) > 30 and kept < 0.35 * 50 * len(tree.paths)
    assert df.select(F.count("*")).first()[0] == 4000
