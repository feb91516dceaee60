"""A14, A15 by block products against plain pairwise-complete correlations."""

import numpy as np
import pandas as pd
import pytest

from riskframe.operators import profile


def _table(rows: int, cols: int, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(rows, 5)) @ rng.normal(size=(5, cols)) + rng.normal(size=(rows, cols))
    base[:, ::7] = base[:, ::7] * 1e-3 + 1e6  # small spread far from zero
    base[rng.random((rows, cols)) < 0.1] = np.nan
    return pd.DataFrame(base, columns=[f"x{i}" for i in range(cols)])


def _got(df) -> dict:
    return {(r["col_a"], r["col_b"]): r["corr"] for r in df.collect()}


def test_two_hundred_columns(spark):
    t = _table(400, 200)
    got = _got(profile.correlation_matrix(spark.createDataFrame(t).repartition(5), list(t.columns)))
    exact = t.to_numpy().astype(np.longdouble)  # doubles alone lose digits of the columns far from zero

    def want(a: str, b: str) -> float:
        x, y = exact[:, t.columns.get_loc(a)], exact[:, t.columns.get_loc(b)]
        held = np.isfinite(x) & np.isfinite(y)
        x, y = x[held] - x[held].mean(), y[held] - y[held].mean()
        return float((x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum()))

    assert len(got) == 200 * 200
    worst = max(abs(v - want(a, b)) for (a, b), v in got.items() if a <= b)
    assert worst < 2e-8
    assert all(got[a, b] == got[b, a] for a, b in got)


def test_constants_missing_values_and_few_rows(spark):
    t = pd.DataFrame({
        "x": [1.0, 2.0, 3.0, 4.0, float("nan"), 6.5],
        "same": [0.1] * 6,
        "gone": [None] * 6,
        "one": [None, 5.0, None, None, None, None],
        "flat": [7.3, 7.3, 7.3, None, 9.0, None],  # constant where x is present
        "y": [2.0, float("inf"), 5.9, 8.1, 1.0, 12.0],
    }).astype(float)
    got = _got(profile.correlation_matrix(spark.createDataFrame(t), list(t.columns)))
    assert got["x", "x"] == pytest.approx(1.0)
    for other in ("same", "gone", "one", "flat"):
        assert got["x", other] is None, other
    assert got["same", "same"] is None
    # infinite values are missing
    assert got["x", "y"] == pytest.approx(np.corrcoef([1, 3, 4, 6.5], [2, 5.9, 8.1, 12])[0, 1])


def test_nearly_constant_pair_is_taken_again(spark):
    """A pair whose rows lie in a narrow range far from the others of its column: centring alone would lose its digits."""
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=300) * 1e-7 + 1e4, rng.normal(size=300)
    x[0], y[0] = -1e4, np.nan
    t = pd.DataFrame({"x": x, "y": y})
    got = _got(profile.correlation_matrix(spark.createDataFrame(t).coalesce(1), ["x", "y"]))
    d = x[1:] - x[1]
    assert got["x", "y"] == pytest.approx(np.corrcoef(d, y[1:])[0, 1], abs=1e-4)


def test_empty_table_and_target(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert _got(profile.correlation_matrix(empty, ["x", "y"])) == {("x", "x"): None, ("x", "y"): None, ("y", "x"): None, ("y", "y"): None}
    assert profile.target_correlations(empty, ["x"], "y").count() == 0
    t = _table(300, 40)
    got = profile.target_correlations(spark.createDataFrame(t).repartition(3), list(t.columns[:-1]), "x39", 10).collect()
    want = t.corr()["x39"].drop("x39").abs().sort_values(ascending=False).head(10)
    assert [r["feature"] for r in got] == list(want.index)
    assert [abs(r["corr"]) for r in got] == pytest.approx(list(want), rel=1e-6)
