import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import models, tree_shap


def _data(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(150, 4))
    y = ((X[:, 0] + 0.5 * X[:, 1] * X[:, 2]) > 0).astype(float)
    rows = [(i, [float(v) for v in X[i]], float(y[i])) for i in range(150)]
    df = spark.createDataFrame(rows, "k long, x array<double>, label double")
    return df.withColumn("features", array_to_vector("x"))


def _check_additivity(spark, model, to_output):
    df = _data(spark)
    phi = tree_shap.tree_shap(df, "k", "x", model)
    tot = {r.k: r.s for r in phi.groupBy("k").agg(F.sum("phi").alias("s")).collect()}
    base = tree_shap.expected_value(tree_shap.tree_tables(spark, model))
    out = model.transform(df).select("k", vector_to_array("probability")[1].alias("p")).collect()
    for r in out:
        assert abs(tot[r.k] + base - to_output(r.p)) < 1e-6


def test_forest_additivity(spark):
    m = models.forest().setNumTrees(8).setMaxDepth(4).fit(_data(spark))
    _check_additivity(spark, m, lambda p: p)


def test_gbt_additivity(spark):
    m = models.boosted().setMaxIter(6).setMaxDepth(3).fit(_data(spark))
    _check_additivity(spark, m, lambda p: float(np.log(p / (1 - p))))
