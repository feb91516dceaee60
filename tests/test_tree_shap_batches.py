import itertools
import math
import time

import numpy as np

from riskframe.operators import tree_shap


def _tree(rng, depth, width):
    left, right, feat, thr, cats, value, cover = [], [], [], [], [], [], []

    def grow(d, rows):
        i = len(left)
        for a, v in ((left, -1), (right, -1), (feat, -1), (thr, 0.0), (cats, None), (value, rng.normal()), (cover, rows)):
            a.append(v)
        if d:
            feat[i], thr[i] = int(rng.integers(width)), rng.normal()
            if rng.random() < 0.2:
                cats[i] = {0.0, 1.0}
            here = rows * rng.uniform(0.2, 0.8)
            left[i] = grow(d - 1, here)
            right[i] = grow(d - 1, rows - here)
        return i

    grow(depth, 100.0)
    return {"left": np.array(left), "right": np.array(right), "feat": np.array(feat), "thr": np.array(thr), "cats": cats, "value": np.array(value), "cover": np.array(cover), "weight": 1.5}


def _expected(t, x, known, node=0):
    """A tree's output when only the features ``known`` are: other splits by their cover."""
    if t["left"][node] < 0:
        return t["value"][node]
    f, below = t["feat"][node], (t["left"][node], t["right"][node])
    if f in known:
        yes = x[f] in t["cats"][node] if t["cats"][node] is not None else x[f] <= t["thr"][node]
        return _expected(t, x, known, below[not yes])
    return sum(t["cover"][b] / t["cover"][node] * _expected(t, x, known, b) for b in below)


def test_shapley_values_by_definition(monkeypatch):
    rng = np.random.default_rng(2)
    width, tables = 5, {"kind": "gbt", "trees": [_tree(rng, 4, 5) for _ in range(2)]}
    X = np.vstack([rng.normal(size=(6, width)), rng.integers(0, 3, size=(3, width))])
    want = np.zeros(X.shape)
    for (r, x), f in itertools.product(enumerate(X), range(width)):
        for size in range(width):
            for s in itertools.combinations([g for g in range(width) if g != f], size):
                share = math.factorial(size) * math.factorial(width - size - 1) / math.factorial(width)
                want[r, f] += share * sum(3.0 * (_expected(t, x, {*s, f}) - _expected(t, x, set(s))) for t in tables["trees"])
    assert np.allclose(tree_shap.shap_matrix(tables, X), want, atol=1e-12)
    # long paths look up the patterns of the batch
    monkeypatch.setattr(tree_shap, "TABLE_FEATURES", 1)
    assert np.allclose(tree_shap.shap_matrix({"kind": "gbt", "trees": tables["trees"]}, X), want, atol=1e-12)


def test_many_rows_at_a_time():
    """Row by row, these 5,000 rows took some minutes."""
    rng = np.random.default_rng(3)
    tables, X = {"kind": "forest", "trees": [_tree(rng, 6, 10) for _ in range(30)]}, rng.normal(size=(5000, 10))
    begun = time.monotonic()
    phi = tree_shap.shap_matrix(tables, X)
    assert time.monotonic() - begun < 30
    for r in range(3):
        output = np.mean([_expected(t, X[r], set(range(10))) for t in tables["trees"]])
        assert abs(phi[r].sum() + tree_shap.expected_value(tables) - output) < 1e-9
