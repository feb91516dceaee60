"""The registered model queries search the full grids.  Fits are few here: every search is recorded, its first map fitted."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

import __spark_entry__ as E
from riskframe.operators import models
from riskframe.plans import training


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, rng = str(tmp_path_factory.mktemp("vectors")), np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=4) + (i % 6 == 0)], int(i % 6)) for i in range(150)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="module")
def searches():
    """Estimator, maps and folds of every search, in order."""
    seen = []

    def search(est, train, maps, fold_col="fold", label="label", parallelism=4, folds=3):
        named = [{p.name: v for p, v in m.items()} for m in maps]
        seen.append((type(est).__name__, named, folds, {r[0] for r in train.select(fold_col).distinct().collect()}))
        short = {est.maxIter: 2} if type(est).__name__ == "GBTClassifier" else {}
        return est.copy({**maps[0], **short}).fit(train.drop(fold_col)), [0.9, *[0.5] * (len(maps) - 1)]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(models, "search", search)
        yield seen


def _of(searches, name):
    (found,) = [s for s in searches if s[0] == name]  # searched once, whoever reads it
    assert found[2] == 5 and found[3] == {0, 1, 2, 3, 4}
    return found[1]


def test_search_takes_all_folds_of_the_column(spark):
    """Five folds, as the default of train_all makes them: the search only took columns of three."""
    rows = [(float(i % 3 == 0), [float(i % 7), float(i % 3 == 0) + i % 5], i % 5) for i in range(60)]
    df = spark.createDataFrame(rows, "label double, v array<double>, fold int")
    df = df.select("label", array_to_vector("v").alias("features"), "fold")
    est = models.logistic()
    best, avg = models.search(est, df, models.logistic_maps(est, 60, {"C": [1, 10], "penalty": ["l2"]}), folds=5)
    assert len(avg) == 2 and best.numFeatures == 2


def test_train_all_searches_every_family_in_full(spark, folder, searches):
    got = {r["model"]: (r["n_test"], r["n_positive"], r["metrics_agree"]) for r in E.queries()["m10_train_all"](spark, folder).collect()}
    assert got == dict.fromkeys(("Logistic Regression", "Random Forest", "GBT"), (30, 5, True))
    assert [len(_of(searches, c)) for c in ("LogisticRegression", "RandomForestClassifier", "GBTClassifier")] == [8, 30, 64]
    boosted = _of(searches, "GBTClassifier")
    assert {m["maxIter"] for m in boosted} == {200, 300} and {m["maxDepth"] for m in boosted} == {5, 6}


def test_families_are_searched_when_read(spark, searches):
    rows = [(i, int(i % 5 == 0), [float(i % 7), float(i % 5 == 0)]) for i in range(100)]
    before = len(searches)
    res = training.train_all(spark.createDataFrame(rows, "k long, y int, v array<double>"), "k", "y", "v")
    assert len(searches) == before and list(res.fitted) == list(training.FAMILIES)
    assert res.scored["random_forest"].count() == 20 and len(res.maps["random_forest"]) == 30
    assert [s[0] for s in searches[before:]] == ["RandomForestClassifier"]
    assert res.metrics.count() == 3 and len(searches) == before + 3
    with pytest.raises(KeyError):
        res.fitted["nothing"]
    del searches[before:]


def test_forest_of_the_best_of_thirty_maps(spark, folder, searches):
    got = E.queries()["m2_random_forest"](spark, folder).collect()
    assert len(got) == 30 and all(r["bounded"] and r["consistent"] for r in got)
    maps = _of(searches, "RandomForestClassifier")
    assert len(maps) == 30 and {m["numTrees"] for m in maps} == {200, 300, 400} and {m["maxDepth"] for m in maps} == {6, 8, 10, 30}


def _by_sql(name, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet/*.parquet')")
    return sorted(map(tuple, con.execute(E.oracle_sql()[name]).fetchall()))


def test_grid_search_has_all_eight_maps(spark, folder, searches):
    got = E.queries()["m5_grid_search_cv"](spark, folder).collect()
    n = 2 * 100  # the larger class of the training part, twice
    want = sorted((round(1 / (c * n), 12), l1, True, True) for c in (0.01, 0.1, 1, 10) for l1 in (0.0, 1.0))
    assert sorted(map(tuple, got)) == want == _by_sql("m5_grid_search_cv", folder)
    assert len(_of(searches, "LogisticRegression")) == 8


def test_random_search_draws_thirty_maps(spark, folder, searches):
    got = E.queries()["m6_random_search_cv"](spark, folder).collect()
    assert sorted(map(tuple, got)) == [(i, True, True, True, True) for i in range(30)] == _by_sql("m6_random_search_cv", folder)
    assert len(_of(searches, "RandomForestClassifier")) == 30
