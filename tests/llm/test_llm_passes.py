"""Bounded passes of the embedding near-dedup, and its comparison of all pairs."""

import numpy as np
import pytest

from patrolspark.llm import embed_dedup as E


def narrow(n, d, cosine, rng):
    """Unit vectors at ``cosine`` to one axis."""
    x = rng.standard_normal((n, d))
    x[:, 0] = 0
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= np.sqrt(1 - cosine ** 2)
    x[:, 0] = cosine
    return x


@pytest.mark.parametrize("cosine", [0.0, 0.9, 0.99, 0.999, 0.9999])
def test_passes_are_bounded(cosine):
    x = narrow(20_000, 64, cosine, np.random.default_rng(2))
    for n in (1_000_000, 10_000_000):
        assert E.LEAST_PASSES <= E.passes_needed(x, x.mean(axis=0), n, 0.98, 0.999, 1024) <= E.MOST_PASSES + 1
    assert E.passes_needed(x, x.mean(axis=0), 10_000_000, 0.98, 0.999, 1024, most=3) == 4


def parts(reps, links):
    low = {r: r for r in reps}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        low[b] = a
    return [root(r) for r in reps]


@pytest.mark.parametrize("cosine", [0.9, 0.99, 0.999])
def test_links_of_a_cone_with_and_without_passes(spark, cosine):
    """Components of the passes, and of the all-pairs comparison beyond the bound, against numpy."""
    n = 1500
    x = narrow(n, 24, cosine, np.random.default_rng(4))
    x[-200:] = x[:200] + 0.05 * np.random.default_rng(6).standard_normal((200, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = parts(range(n), np.argwhere(np.triu(x @ x.T >= 0.98, 1)).tolist())
    reps = spark.createDataFrame([(i, "ab"[i % 3 == 7], 24, v.tolist()) for i, v in enumerate(x)], "rep long, label string, dim int, vec array<double>")
    same = {most: parts(range(n), E.links(reps, window=64, block=256, most=most).collect()) for most in (0, 256)}
    assert same[0] == want
    assert np.mean([a == b for a, b in zip(same[256], want, strict=True)]) >= 0.99


def test_unite():
    rng = np.random.default_rng(0)
    for _ in range(20):
        label = np.arange(60)
        a, b = rng.integers(60, size=(2, 40))
        E._unite(label, a[:20].copy(), b[:20].copy())
        E._unite(label, a[20:].copy(), b[20:].copy())
        assert label.tolist() == parts(range(60), zip(a.tolist(), b.tolist(), strict=True))
