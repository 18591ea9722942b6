import numpy as np
from pyspark.sql import functions as F

from panelweave.llm import kdtree
from panelweave.llm.queries import OP9_SQL, op9_kdtree
from tests.oracle import assert_same, duck


def brute(rows, k):
    ok = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, v in ok:
        if i % 10 == 0:
            s = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j) for j, w in ok if j != i and len(w) == len(v))
            out |= {(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])}
    return out


def check(spark, rows, k=10, parts=3):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(parts)
    got = {tuple(r) for r in kdtree.top_k(df, F.col("vec_id") % 10 == 0, k).collect()}
    assert got == brute(rows, k)


def vectors(rng, n, d=8):
    return [(k, rng.normal(size=d).astype(np.float32).tolist()) for k in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "LEAF_ROWS", 8)
    check(spark, vectors(np.random.default_rng(1), 400))
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 50)
    monkeypatch.setattr(kdtree, "QUERY_BLOCK", 11)
    check(spark, vectors(np.random.default_rng(2), 300), parts=1)


def test_ties_repeats_nulls_and_odd_lengths(spark):
    rng = np.random.default_rng(3)
    rows = vectors(rng, 60)
    rows += [(100 + k, rows[0][1]) for k in range(30)]  # one very common vector
    rows += [(200, None), (210, [None] * 8), (220, [float("nan")] * 8), (230, [float("inf")] * 8), (240, [1.0, 2.0]), (241, [3.0, 4.0]), (250, []), (251, []), (None, rows[1][1])]
    rows += [(300, [1e30] * 8), (301, [-1e30] * 8), (302, [1e30] * 8), (310, [1e30] * 8)]  # products beyond 64 bits
    check(spark, rows)
    check(spark, [(0, [1e5] * 4), (1, [2e5, 1.0, -3e5, 0.5]), (2, [1.0] * 4)])


def test_fewer_than_k_and_empty(spark):
    check(spark, vectors(np.random.default_rng(4), 4))
    check(spark, vectors(np.random.default_rng(4), 1))
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert kdtree.top_k(empty, F.col("vec_id") % 10 == 0).count() == 0


def test_boxes_bound_their_points_and_prune():
    rng = np.random.default_rng(5)
    points = np.floor(1024 * np.concatenate([rng.normal(c, 0.1, (1000, 6)) for c in (-3, 0, 3)]))
    tree = kdtree.KdTree(np.arange(3000), points)
    q = points[rng.integers(0, 3000, 20)]
    bounds = tree.bounds(q)
    for n, (i, j) in enumerate(tree.span):
        assert ((tree.points[i:j] @ q.T).max(axis=0) <= bounds[:, n] + 1e-6).all()
    best = (points @ q[0]).max()
    assert (bounds[0] >= best).sum() < 0.5 * len(tree.span)


def test_query(spark, sf):
    assert_same(op9_kdtree(spark, sf), duck(sf).sql(OP9_SQL))
