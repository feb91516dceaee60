import os

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskframe.operators import explain, models, score
from riskframe.spec import Roles

SF = "/root/testdata/sf0.001"


def _data(spark):
    rows = [(i, [float(i % 7), float((i * 3) % 11)], int(i % 7 > 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, v array<double>, y int")
    return df.select("k", array_to_vector("v").alias("features"), F.col("y").cast("double").alias("label"))


def test_f1_macro_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    assert models.F1MacroEvaluator().evaluate(df) == 0.5


def test_cv_search_and_save_load(spark, tmp_path):
    df = _data(spark).withColumn("fold", (F.col("k") % 3).cast("int"))
    est = models.logistic()
    maps = models.logistic_maps(est, 200, {"C": [0.1, 1], "penalty": ["l2"]})
    best, avg = models.search(est, df, maps, parallelism=2)
    assert len(avg) == 2
    pm = models.full_pipeline([], best)
    models.save_model(pm, str(tmp_path / "m"))
    back = models.load_model(str(tmp_path / "m"))
    a = [r.score for r in models.predict_proba(pm, df).orderBy("k").collect()]
    b = [r.score for r in models.predict_proba(back, df).orderBy("k").collect()]
    assert a == b
    imp = explain.feature_importance(spark, best, ["a", "b"], 10).collect()
    assert [round(r.importance, 12) for r in imp] == sorted([round(abs(x), 12) for x in best.coefficients], reverse=True)


def test_forest_importances_sum_to_one(spark):
    m = models.forest().setNumTrees(5).setMaxDepth(3).fit(_data(spark))
    imp = explain.feature_importance(spark, m, ["a", "b"], 10).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9


def test_random_search_sample():
    maps = [{"a": i} for i in range(10)]
    assert models.sample_maps(maps, 3) == models.sample_maps(maps, 3) and len(models.sample_maps(maps, 3)) == 3


def test_linear_shap_additivity(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, -1.0)], "k int, a double, b double")
    w = {"a": 0.5, "b": -2.0}
    means = explain.background_means(df, list(w))
    phi = explain.linear_contributions(df, "k", w, means)
    tot = {r.k: r.s for r in phi.groupBy("k").agg(F.sum("phi").alias("s")).collect()}
    base = sum(w[f] * means[f] for f in w)
    for r in df.collect():
        assert abs(tot[r.k] + base - (0.5 * r.a - 2.0 * r.b)) < 1e-12
    top = explain.top_contributions(phi, "k", 1).collect()
    assert all(t["rank"] == 1 for t in top) and {t.direction for t in top} <= {"increases", "decreases"}


def test_complete_records_and_defaults(spark):
    raw = spark.createDataFrame([(1.0, "a", 2), (3.0, "b", 3), (5.0, "a", 4)], "x double, c string, o int")
    d = score.compute_defaults(raw, ["x"], ["c"], ["o"])
    assert d == {"x": 3.0, "c": "a", "o": 3}
    part = spark.createDataFrame([(None,), (7.0,)], "x double")
    out = score.complete_records(part, d).collect()
    assert [(r.x, r.c, r.o) for r in out] == [(3.0, "a", 3), (7.0, "a", 3)]


def test_score_table_with_pipeline(spark):
    from riskframe.operators import encode
    raw = spark.createDataFrame([(i, float(i), "Yes" if i % 3 == 0 else "No") for i in range(60)],
                                "k int, x double, t string")
    roles = Roles(target="t", key="k", numerical=("x",), target_map={"Yes": 1, "No": 0})
    from riskframe.operators import clean
    cleaned = clean.clean_raw(raw, roles)
    enc = encode.fit_encoder(cleaned, {}, [], ["x"])
    stages = enc.to_stages()
    from pyspark.ml import Pipeline
    prep = Pipeline(stages=stages).fit(cleaned)
    m = models.logistic(label="t").fit(prep.transform(cleaned).withColumn("t", F.col("t").cast("double")))
    pm = models.full_pipeline(prep.stages, m)
    out = score.score_table(raw.drop("t"), roles, pm, ["x"]).collect()
    assert len(out) == 60 and {r.Prediction for r in out} <= {"Yes", "No"}


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"column", "level", "n", "rate_pct"}
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 70


def test_streaming_scoring(spark, tmp_path):
    from riskframe.operators import encode
    from riskframe.streaming import scoring
    src = str(tmp_path / "in")
    raw = spark.createDataFrame([(i, float(i)) for i in range(20)], "k int, x double")
    raw.write.parquet(src)
    enc = encode.fit_encoder(raw, {}, [], ["x"])
    from pyspark.ml import Pipeline
    prep = Pipeline(stages=enc.to_stages()).fit(raw)
    train = prep.transform(raw).withColumn("label", (F.col("x") > 9).cast("double"))
    pm = models.full_pipeline(prep.stages, models.logistic().fit(train))
    s = scoring.score_stream(spark, src, "k int, x double", Roles(target=None, key="k"), pm)
    q = scoring.start(s, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
