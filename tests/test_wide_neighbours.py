import time

import numpy as np

from riskframe.operators import neighbours


def _df(spark, X, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in x]) for i, x in enumerate(X)], "k long, v array<double>")


def _want(X, k):
    out = {}
    for i, x in enumerate(X):
        d = np.zeros(len(X))
        for c in range(X.shape[1]):
            d += (x[c] - X[:, c]) * (x[c] - X[:, c])
        order = [j for j in np.lexsort((np.arange(len(X)), d)) if j != i][:k]
        out[i] = [(j, d[j]) for j in order]
    return out


def _got(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["k"], r["j"])):
        out.setdefault(r["k"], []).append((r["nb_key"], r["dist2"]))
    return out


def test_unstructured_wide_points_as_blocks(spark):
    """9 million pairs of 64 entries: one by one in SQL they took some 90 CPU seconds."""
    X = np.random.default_rng(1).normal(size=(3000, 64))
    begun = time.monotonic()
    got = _got(neighbours.knn(_df(spark, X), "k", "v", 5))
    assert time.monotonic() - begun < 60
    assert got == _want(X, 5)


def test_ties_and_close_points_in_blocks(spark, monkeypatch):
    """Equal distances go to the smaller key, and points far from zero but near each other keep their exact order."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 7)
    monkeypatch.setattr(neighbours, "BLOCK_CANDIDATES", 11)
    rng = np.random.default_rng(2)
    grid = rng.integers(0, 2, size=(150, 9)).astype(float)
    assert _got(neighbours.knn(_df(spark, grid), "k", "v", 4)) == _want(grid, 4)
    far = 1e6 + rng.normal(size=(120, 12)) * 1e-3
    assert _got(neighbours.knn(_df(spark, far), "k", "v", 4)) == _want(far, 4)
