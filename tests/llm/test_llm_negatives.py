"""Hard-negative mining against all pairs in Python integers."""

import math
import random

import numpy as np
import pytest

import helpers as H
from patrolspark.llm import hard_negatives as N

SCHEMA = "vec_id long, label string, embedding array<double>"


def brute(rows, every=5, positives=5, negatives=3):
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v and all(x is not None and math.isfinite(256 * x) for x in v)]
    out = []
    for i, lab, v in ok:
        if i % every:
            continue
        score = [(sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in ok if len(w) == len(v)]
        near = sorted((-s, j) for s, j, other in score if other == lab and j != i)[:positives]
        for s, j in near:
            s = -s
            inside = sorted((-t, k) for t, k, other in score if other != lab and 50 * s <= 100 * t <= 95 * s)
            out += [(i, j, r, k, s, -t) for r, (t, k) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every=5, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, N.mine(H.with_clashes(df), N.F.col("vec_id") % every == 0, **kw).collect()))


def vectors(n, dim, seed, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((labels, dim))
    lab = rng.integers(labels, size=n)
    x = 0.7 * centre[lab] + 0.5 * rng.standard_normal((n, dim)) + 0.4
    return [(i, f"l{k}", [float(y) for y in v]) for i, (k, v) in enumerate(zip(lab, x, strict=True))]


@pytest.mark.parametrize("block", [16, 1000])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "LEAF", 4)
    monkeypatch.setattr(N, "PAGE", 3)
    monkeypatch.setattr(N, "CELL", 7)
    rows = vectors(130, 5, 1)
    rows += [(200 + k, "l0", rows[k][2]) for k in range(20)] + [(300, "solo", [1.0] * 5), (305, "l1", [0.0] * 5)]
    want = brute(rows)
    assert len(want) > 100 and mined(spark, rows, block=block) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 3, 2, 2) + [
        (50, None, [1.0, 1.0, 1.0]), (55, "l0", None), (60, "l0", []), (65, "l0", [1.0, None, 1.0]), (70, "l0", [nan, 1.0, 1.0]),
        (75, "l0", [inf, 1.0, 1.0]), (80, "l0", [1e308, 1.0, 1.0]), (None, "l0", [1.0, 1.0, 1.0]), (85, "l0", [1.0, 1.0]),
        (86, "l0", [1.0, 2.0]), (87, "l1", [1.0, 0.9]), (90, "l1", [2.0])]
    want = brute(rows)
    assert any(r[0] == 85 for r in want) and mined(spark, rows) == want


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, f"l{i % 2}", [float(rng.randrange(1 << 21, 1 << 22)) + rng.random() for _ in range(4)]) for i in range(30)]
    want = brute(rows)
    assert want and max(r[4] for r in want) > 1 << 53 and mined(spark, rows) == want
    past = [(0, "a", [1e30, 1.0]), (1, "a", [1e30, 1.0]), (2, "b", [6e29, 1.0]), (3, "b", [1e-16, 0.0])]
    assert mined(spark, past) == []  # all scores with anchor 0 count as the end of the range, or are 0



def test_repeated_rows_and_empty(spark):
    one = [(0, "a", [1.0, 0.0]), (1, "a", [1.0, 0.0]), (2, "b", [0.8, 0.0])]
    twice = mined(spark, one + one[:1])
    assert twice == [(0, 1, 1, 2, 65536, 52224)] * 2
    assert mined(spark, []) == []
    assert mined(spark, one[:1]) == []


def test_float_vectors(spark):
    """Floats count as doubles: 3e38 times 256 is finite there."""
    rows = [(i, lab, [float(np.float32(x)) for x in v]) for i, lab, v in vectors(60, 4, 7)] + [(95, "l0", [3e38, 0.0, 0.0, 0.0])]
    rows[-1] = (95, "l0", [float(np.float32(3e38)), 0.0, 0.0, 0.0])
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>")
    plain = brute(rows[:-1])
    got = sorted(map(tuple, N.mine(df, N.F.col("vec_id") % 5 == 0).collect()))
    assert [r for r in got if 95 not in (r[0], r[1])] != [] and mined(spark, rows[:-1]) == plain
    assert got == sorted(map(tuple, N.mine(spark.createDataFrame(rows, SCHEMA), N.F.col("vec_id") % 5 == 0).collect()))


def test_queue_prunes():
    """Boxes strictly below the k-th score are never opened."""
    x = np.arange(4096, dtype=float).reshape(-1, 1)
    tree = N.Tree(x, np.arange(4096), np.array(["a"] * 4096), leaf=16)
    seen = []
    real = N._products
    try:
        N._products = lambda rows, a: seen.append(len(rows)) or real(rows, a)
        low, high = tree.bounds(np.array([[2.0]]))
        best = tree.search(np.array([2.0]), -1, "a", True, [[-np.inf, np.inf, None]], 5, low[0], high[0])
        window = tree.search(np.array([2.0]), -1, "b", False, [[1000, 1100, None]], 3, low[0], high[0])
    finally:
        N._products = real
    assert sorted(best[0], reverse=True) == [(2 * (4095 - k), -(4095 - k)) for k in range(5)]
    assert sorted(window[0], reverse=True) == [(1100, -550), (1098, -549), (1096, -548)]
    assert sum(seen) <= 64


def test_tree_covers_all_rows():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1000, 6))
    tree = N.Tree(x, np.arange(1000), rng.integers(4, size=1000).astype(str), leaf=16, fan=4)
    assert sorted(tree.ids) == list(range(1000)) and tree.rows[-1][1] == 1000
    a = rng.standard_normal((3, 6))
    low, high = tree.bounds(a)
    for k, (s, e) in enumerate(tree.rows):
        score = tree.x[s:e] @ a.T
        assert (score.min(axis=0) >= low[:, k] - 1e-9).all() and (score.max(axis=0) <= high[:, k] + 1e-9).all()
