import math

import numpy as np
from pyspark.sql import functions as F

from riskframe.functions.ranking import exact_quantiles, hash_rank
from riskframe.functions.exprs import seeded_md5
from riskframe.functions import ranking
from riskframe.operators import profile, sample


def test_quotas_golden():
    assert sample.test_quotas({0: 1233, 1: 237}, 0.2) == {0: 247, 1: 47}


def test_split_exact_sizes_and_partition_invariance(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    a = sample.split(df, "k", "y", 0.2, 42)
    counts = {(r.y, r.split): r["count"] for r in a.groupBy("y", "split").count().collect()}
    q = sample.test_quotas({0: 857, 1: 143}, 0.2)
    assert counts[(0, "test")] == q[0] and counts[(1, "test")] == q[1]
    b = sample.split(df.repartition(13), "k", "y", 0.2, 42)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_hash_rank_equals_sorted_order(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    d = df.withColumn("h", seeded_md5(7, "k"))
    got = {(r.g, r.k): r["rank"] for r in hash_rank(d, "h", ["k"], ["g"], name="rank", hex_digits=2).collect()}
    rows = sorted(d.collect(), key=lambda r: (r.g, r.h, r.k))
    expect, last, n = {}, None, 0
    for r in rows:
        n = n + 1 if r.g == last else 1
        last = r.g
        expect[(r.g, r.k)] = n
    assert got == expect


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=500), np.full(300, 0.25)])  # a hot value
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    q = {r.prob: r.value for r in exact_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9]).collect()}
    for p in (0.1, 0.25, 0.5, 0.9):
        assert math.isclose(q[p], float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-12)


def test_bracketed_quantiles(spark, monkeypatch):
    """Narrowed brackets, hot values, few rows, ends, NaN and null as missing, columns without values."""
    monkeypatch.setattr(ranking, "BRACKET_ROWS", 40)
    monkeypatch.setattr(ranking, "BRACKET_ACCURACY", 50)
    rng = np.random.default_rng(8)
    cols = {"a": rng.normal(size=4000), "hot": np.where(rng.random(4000) < 0.4, 7.0, rng.normal(size=4000) + 7), "two": (rng.random(4000) < 0.5).astype(float),
            "gone": np.full(4000, np.nan), "some": np.where(rng.random(4000) < 0.3, np.nan, rng.pareto(0.5, size=4000))}
    rows = [tuple(float(v[i]) for v in cols.values()) + (i if i < 3 else None,) for i in range(4000)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", few long").repartition(7)
    probs = [0.0, 0.003, 0.25, 0.5, 0.75, 0.9991, 1.0]
    got = {(r.column, r.prob): r.value for r in exact_quantiles(df, [*cols, "few"], probs).collect()}
    cols["few"] = np.array([0.0, 1.0, 2.0])
    for c, v in cols.items():
        v = v[~np.isnan(v)]
        for p in probs:
            assert (got[c, p] is None) if not len(v) else math.isclose(got[c, p], float(np.quantile(v, p)), rel_tol=1e-12, abs_tol=1e-12), (c, p)
    assert exact_quantiles(df.limit(0), ["a"], [0.5]).first()["value"] is None


def test_nan_is_missing_in_profiles(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, None), (float("nan"), 3), (float("nan"), 4), (None, 5)], "x double, n int")
    d = profile.describe(df, ["x"]).first()
    assert (d["count"], d["mean"], d["p25"], d["p50"], d["max"]) == (2, 1.5, 1.25, 1.5, 2.0)
    assert {r["column"]: r["n_null"] for r in profile.null_counts(df).collect()} == {"x": 3, "n": 1}


def test_folds_balanced(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    f = sample.assign_folds(df, "k", "y", 5)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes == [100] * 5 and dict(f.dtypes)["fold"] == "int"


def test_knn_matches_brute_force_with_duplicates(spark):
    rng = np.random.default_rng(0)
    pts = rng.normal(size=(120, 4))
    pts[10] = pts[11]  # exact duplicate
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    got = {(r.k, r.j): r.nb_key for r in sample.knn(df, "k", "v", 5, leaf=8).collect()}
    for i, p in enumerate(pts):
        d = [(float(((p - q) ** 2).sum()), j) for j, q in enumerate(pts) if j != i]
        best = sorted(d)[:5]
        for j, (_, nb) in enumerate(best, 1):
            assert got[(i, j)] == nb


def _brute(rows, k):
    out = {}
    for i, p in rows:
        d = sorted((sum((x - y) ** 2 for x, y in zip(p, q)), j) for j, q in rows if j != i)[:k]
        out[i] = [(j, x) for x, j in d]
    return out


def _check_knn(spark, rows, k, **kw):
    counts = {}
    got = {}
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in rows], "k long, v array<double>")
    for r in sample.knn(df, "k", "v", k, counts=counts, **kw).collect():
        got.setdefault(r.k, {})[r.j] = (r.nb_key, r.dist2)
    want = _brute([(i, [float(x) for x in p]) for i, p in rows], k)
    for i, near in want.items():
        mine = [got.get(i, {}).get(j + 1) for j in range(len(near))]
        assert [m[0] for m in mine] == [n[0] for n in near] and np.allclose([m[1] for m in mine], [n[1] for n in near], rtol=1e-9)
    return counts


def test_knn_prunes_skewed_points_with_hot_values(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (int(rng.pareto(1.0) * 100), int(rng.pareto(1.0) * 20), int(rng.random() < 0.05))) for i in range(900)]
    rows += [(1000 + i, (50, 10, 0)) for i in range(300)]  # a third of all rows are one vector
    counts = _check_knn(spark, rows, 5)
    assert counts["largest_leaf"] <= 12 and counts["pairs"] <= 0.1 * counts["points"] ** 2


def test_knn_ties_on_a_grid_and_few_points(spark):
    _check_knn(spark, [(99 - i, (i % 10, i // 10)) for i in range(100)], 5)
    _check_knn(spark, [(1, (0, 0)), (2, (0, 0)), (3, (1, 1))], 5)
    assert sample.knn(spark.createDataFrame([(1, [1.0])], "k long, v array<double>"), "k", "v", 5).count() == 0
    assert sample.knn(spark.createDataFrame([], "k long, v array<double>"), "k", "v", 5).count() == 0


def test_knn_wide_clusters_by_pivots(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 24)) * 10
    rows = [(i, (centres[i % 12] + rng.normal(size=24) * 0.05).tolist()) for i in range(360)]
    counts = _check_knn(spark, rows, 3)
    assert counts["pairs"] <= 0.3 * counts["points"] ** 2


def test_smote_counts_and_segments(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=3)], 1 if i < 20 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, v array<double>, y int")
    out = sample.smote(df, "k", "y", "v", k=5, seed=42)
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 80, 1: 80}
    minority = np.array([r[1] for r in rows if r[2] == 1])
    for r in out.where("is_synthetic").collect():
        x = np.array(r.v)
        # on a segment between two minority points: some pair (a, b) with x = a + t (b - a), t in [0, 1)
        ok = False
        for a in minority:
            for b in minority:
                d = b - a
                if np.allclose(d, 0):
                    continue
                t = float(np.dot(x - a, d) / np.dot(d, d))
                if -1e-9 <= t < 1 + 1e-9 and np.allclose(a + t * d, x, atol=1e-9):
                    ok = True
                    break
            if ok:
                break
        assert ok
    again = sample.smote(df.repartition(7), "k", "y", "v", k=5, seed=42)
    assert sorted(map(lambda r: (r.k, tuple(r.v)), out.collect())) == sorted(map(lambda r: (r.k, tuple(r.v)), again.collect()))


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    w = {r.y: r.weight for r in sample.balanced_weights(df, "y").distinct().collect()}
    assert w == {0: 8 / 12, 1: 2.0}
