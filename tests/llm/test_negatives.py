"""Hard negatives against all inner products in plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelgrid.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def brute(rows, is_anchor, k=5, n=10):
    kept = {(i, g, tuple(whole(v))) for i, v, g in rows if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, g, v in kept:
        if not is_anchor(i):
            continue
        pos = sorted((-dot(v, w), j) for j, h, w in kept if h == g and j != i)[:k]
        for s, p in pos:
            neg = sorted((-dot(v, w), j) for j, h, w in kept if h != g and 30 * -s <= 100 * dot(v, w) <= 90 * -s)[:n]
            out += [(i, p, r, j, -s, -t) for r, (t, j) in enumerate(neg, 1)]
    return sorted(out)


def clustered(seed, n, dim=8, groups=12, spread=0.05):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dim))
    return [(i, (centers[i % groups] + rng.normal(size=dim) * spread).astype(np.float32).tolist(), int(rng.integers(4))) for i in range(n)]


def run(spark, rows, every=10, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in N.mine(df, F.col("id") % every == 0, F.col("label"), **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"shard": 40, "block": 7, "leaf": 3}, {"base": 1.2, "leaf": 1}])
def test_equals_all_products(spark, kw):
    rows = clustered(1, 300)
    assert run(spark, rows, **kw) == brute(rows, lambda i: i % 10 == 0)


def test_random_directions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(250)]
    assert run(spark, rows, shard=100) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rows = clustered(2, 80)
    same = rows[0][1]
    rows += [(200 + i, same, i % 3) for i in range(60)]  # one vector many times, ties by id
    rows += [(300, None, 1), (310, [1.0] * 8, None), (320, [1.0, None] + [0.0] * 6, 1), (330, [float("nan")] * 8, 1), (340, [float("inf")] * 8, 1),
             (None, same, 1), (350, [], 1), (360, [0.5, 0.5], 1), (370, [0.0] * 8, 2), rows[10], rows[20], (30, rows[31][1], 1)]
    assert run(spark, rows, leaf=4) == brute(rows, lambda i: i % 10 == 0)


def test_empty_and_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0), (3, [2.0], 1)]) == []
    assert run(spark, [(10, [1.0], 0)]) == []
    df = spark.createDataFrame([(10, [1.0], 0, "x"), (11, [1.0], 0, "y"), (12, [0.5], 1, "z")], "vec_id long, embedding array<double>, label int, `rank` string")
    assert [tuple(r) for r in N.mine(df, F.col("id") == 10, F.col("label")).collect()] == [(10, 11, 1, 12, 65536, 32768)]


@pytest.mark.parametrize("leaf", [1, 5, 24])
def test_tree_covers_and_separates(leaf):
    rows = clustered(4, 400)
    vectors = np.array([whole(v) for _, v, _ in rows], dtype=float)
    t = N.build(np.arange(400), np.zeros(400, dtype=np.int64), vectors, leaf)
    assert sorted(t.ids) == list(range(400)) and (t.vectors == vectors[t.ids]).all()
    lifted = np.hstack((t.vectors, np.sqrt(np.maximum(0, t.m**2 - (t.vectors**2).sum(axis=1)))[:, None]))
    leaves = 0
    for v in range(len(t.start)):
        below = lifted[t.start[v]:t.end[v]]
        assert t.start[v] <= t.center[v] < t.end[v]
        assert np.sqrt(((below - lifted[t.center[v]]) ** 2).sum(axis=1)).max() <= t.radius[v]
        children = range(t.first[v], t.last[v])
        leaves += not len(children)
        if len(children):
            assert [t.start[children[0]], t.end[children[-1]]] == [t.start[v], t.end[v]]
            assert all(t.end[a] == t.start[a + 1] for a in list(children)[:-1])
            centers = lifted[t.center[children]]
            gaps = np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(axis=2))[np.triu_indices(len(centers), 1)]
            assert t.center[children[0]] == t.center[v] and gaps.min() > (t.radius[v] - 1e-3) / N.BASE - 1e-3
    assert leaves > 10


def test_descent_skips_nodes():
    """Of well separated groups, far fewer products are taken than there are."""
    rows = clustered(6, 3000, groups=60, spread=0.01)
    vectors = np.array([whole(v) for _, v, _ in rows], dtype=float)
    labels = np.array([i % 60 % 3 for i in range(3000)])
    t = N.build(np.arange(3000), labels, vectors)
    who = np.arange(0, 3000, 100)
    everything = np.full(len(who), np.inf)
    a = N.Anchors(who, labels[who], vectors[who], np.arange(len(who)), -everything, everything, 5, True)
    best = N.Best(a)
    taken = N.descend(t, a, best)
    assert taken < 0.35 * len(who) * 3000
    dots = vectors[who] @ vectors.T
    for j, i in enumerate(who):
        want = sorted((-dots[j, x], x) for x in range(3000) if labels[x] == labels[i] and x != i)[:5]
        assert list(zip(-best.score[j], best.id[j], strict=True)) == want
