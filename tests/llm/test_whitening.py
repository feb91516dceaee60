"""Whitening against eigenvectors of the plain covariance."""
import math

import numpy as np

from riskframe.llm import whitening

ROWS = "vec_id long, embedding array<float>, component int, n string, whitened string"


def table(spark, vectors, parts=5):
    return spark.createDataFrame([(i, v, 7, "x", "y") for i, v in vectors], ROWS).repartition(parts)


def plain(vectors):
    keep = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in keep}), dtype=np.int64)
    n, s = len(fit), fit.sum(axis=0)
    a = fit - s / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    return keep, n, s, values[::-1], vectors[:, ::-1]


def check(got, vectors, held=4):
    keep, n, s, values, vecs = plain(vectors)
    assert len(got) == held * len(keep)
    flip = {}
    want = {}
    for i, x in keep:
        w = (np.array(x) - s / n) @ vecs[:, :held] / np.sqrt(values[:held])
        want.setdefault(i, []).append((sum((n * int(v) - int(t)) ** 2 for v, t in zip(x, s, strict=True)), w))
    for r in got:
        c = r["component"] - 1
        assert r["n"] == n and abs(r["explained"] / (values[c] / values.sum()) - 1) < 1e-6 and r["identity_error"] < 1e-9
        near = [w[c] for d, w in want[r["id"]] if d == r["deviation"]]
        assert near
        if abs(near[0]) > 0.5:
            flip.setdefault(c, np.sign(near[0] * r["whitened"]))
    for r in got:
        c = r["component"] - 1
        assert min(abs(flip[c] * r["whitened"] - w[c]) for d, w in want[r["id"]] if d == r["deviation"]) < 1e-7


def test_equals_eigenvectors(spark):
    rng = np.random.default_rng(12)
    mix = rng.normal(size=(12, 12)) * np.geomspace(1, 1e-3, 12)[:, None]
    vectors = [(i, [float(np.float32(c)) for c in rng.normal(size=12) @ mix]) for i in range(400)]
    hot = vectors[0][1]
    vectors += [(1000 + i, hot) for i in range(200)] + [(0, hot), (0, hot), (None, hot)]
    vectors += [(2000, None), (2001, []), (2002, [None] + hot[1:]), (2003, [float("nan")] + hot[1:]), (2004, [float("inf")] + hot[1:])]
    check(whitening.whitened(table(spark, vectors)).collect(), vectors)


def test_dependent_columns_and_small_tables(spark):
    rng = np.random.default_rng(3)
    flat = [(i, [a, b, a, 0.0, a + b, 3.0]) for i, (a, b) in enumerate(rng.integers(-9, 9, size=(300, 2)).astype(float).tolist())]
    check(whitening.whitened(table(spark, flat)).collect(), flat, held=2)
    assert whitening.whitened(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    assert whitening.whitened(table(spark, [])).count() == 0
    two = [(1, [0.0, 0.0]), (2, [1.0, 1.0])]
    check(whitening.whitened(table(spark, two)).collect(), two, held=1)
    lengths = [(i, [float(i), float(i * i)]) for i in range(9)] + [(50, [1.0, 2.0, 3.0])]
    assert {r["id"] for r in whitening.whitened(table(spark, lengths)).collect()} == set(range(9))


def test_huge_components(spark):
    vectors = [(i, [1e15 * i, float(i % 3), 0.5 * (i % 7)]) for i in range(30)]
    got = whitening.whitened(table(spark, vectors)).collect()
    assert got and all(r["deviation"] is None or r["deviation"] >= 0 for r in got) and {r["id"] for r in got} == set(range(30))


def test_ill_conditioned(spark):
    """Columns of scales 1 to 1e-7 of each other: one Cholesky pass of the plain Gram matrix is far from orthonormal."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(500, 6)) @ np.triu(np.ones((6, 6))) * np.geomspace(1, 1e-7, 6)
    a = (a[:, :1] + a) - a.mean(axis=0)

    def gram(factors):
        q = a
        for r in factors:
            q = whitening._solved(q, r)
        return q.T @ q

    r, _, passes = whitening.cholesky_qr(gram, 500, 6)
    q = whitening._solved(a, r)
    assert passes > 1 and np.abs(r.T @ r - a.T @ a).max() < 1e-9 * np.abs(a.T @ a).max()
    assert np.abs(np.linalg.svd(r)[1] / np.linalg.svd(a)[1] - 1).max() < 1e-8 and np.abs(q.T @ q - np.eye(6)).max() < 1e-6


def test_tree_of_partials(spark):
    parts = spark.range(300).selectExpr("id as part", "array(cast(id as double), 1d) as values")
    assert whitening.summed(parts, 300).tolist() == [300 * 299 / 2, 300.0]
