"""Registered queries: models M1-M11, X1, S8 on the embeddings table.

Fits are iterative, not SQL; the SQL checks what must hold of them: which rows are scored, that scores and labels agree, which
parameters are searched and that the best is refitted, that counts and metrics add up, and that saved models score alike."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.operators import models, tree_shap
from riskframe.plans import training
from riskframe.plans.catalog import DOC_SUBJECT_SQL, query, with_views
from riskframe.plans.queries_eval import SC_SQL, SCORERS, _f1_sql, scored_docs
from riskframe.plans.queries_features import STRAT_SQL
from riskframe.plans.subjects import vec_subject
from riskframe.session import ensure_checkpoint_dir
from riskframe.spec import MODEL_DISPLAY

_CACHE: dict = {}


def _trained(spark, sf_dir):
    """The full search, once a session for all queries; each family is searched when a query first reads it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = training.train_all(vec_subject(spark, sf_dir), "vec_id", "target", "features_arr")
    return _CACHE[key]


#: The embeddings as subject with their split; the resampled training part has twice its larger class.
VEC_SQL = "vec_subject AS (SELECT vec_id, CAST(label = 0 AS INTEGER) AS label FROM embeddings)"
VEC_SPLIT_SQL = STRAT_SQL.replace("doc_subject", "vec_subject").replace("doc_id", "vec_id")
TRAIN_SQL = """tn AS (SELECT 2 * max(c) AS n_train FROM (SELECT count(*) AS c FROM sp WHERE split = 'train' GROUP BY label))"""
SCORED_SQL = with_views(VEC_SQL, VEC_SPLIT_SQL) + """
SELECT vec_id, CAST(label AS DOUBLE) AS label, true AS bounded, true AS consistent FROM sp WHERE split = 'test'"""


def _facts(spark, sf_dir, name):
    """Scored rows of the test part: is the score a probability, and the label the likelier class?"""
    s = _trained(spark, sf_dir).scored[name]
    likelier = F.when(F.col("score") > 0.5, 1.0).when(F.col("score") < 0.5, 0.0).otherwise(F.col("prediction"))
    return s.select("vec_id", "label", F.coalesce(F.col("score").between(0, 1), F.lit(False)).alias("bounded"),
                    F.coalesce(F.col("prediction") == likelier, F.lit(False)).alias("consistent"))


@query("m1_logistic_regression", SCORED_SQL)
def m1_logistic_regression(spark, sf_dir):
    return _facts(spark, sf_dir, "logistic_regression")


@query("m2_random_forest", SCORED_SQL)
def m2_random_forest(spark, sf_dir):
    return _facts(spark, sf_dir, "random_forest")


@query("m3_gbt", SCORED_SQL)
def m3_gbt(spark, sf_dir):
    return _facts(spark, sf_dir, "gbt")


def _search_rows(spark, sf_dir, name) -> list[tuple[dict, bool, bool]]:
    """For each searched map: its values by name, is its mean score a share, and is the refitted model the one of the best map?"""
    res = _trained(spark, sf_dir)
    avg, maps, best = res.cv_metrics[name], res.maps[name], res.fitted[name]
    top = maps[max(range(len(avg)), key=lambda i: avg[i])]
    refitted = all(best.getOrDefault(best.getParam(q.name)) == v for q, v in top.items())
    return [({q.name: v for q, v in m.items()}, bool(0.0 <= a <= 1.0), refitted) for m, a in zip(maps, avg, strict=True)]


@query("m5_grid_search_cv", with_views(VEC_SQL, VEC_SPLIT_SQL, TRAIN_SQL) + """
SELECT round(1.0::DOUBLE / (c * n_train), 12) AS reg_param, l1, true AS bounded, true AS best_refitted
FROM tn, (VALUES (0.01::DOUBLE), (0.1::DOUBLE), (1.0::DOUBLE), (10.0::DOUBLE)) g(c), (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) h(l1)""")
def m5_grid_search_cv(spark, sf_dir):
    rows = [(float(m["regParam"]), float(m["elasticNetParam"]), b, r) for m, b, r in _search_rows(spark, sf_dir, "logistic_regression")]
    return spark.createDataFrame(rows, "reg_param double, l1 double, bounded boolean, best_refitted boolean").withColumn("reg_param", F.round("reg_param", 12))


@query("m6_random_search_cv", """
SELECT CAST(i AS INTEGER) AS draw, true AS in_space, true AS distinct_map, true AS bounded, true AS best_refitted FROM range(30) t(i)""")
def m6_random_search_cv(spark, sf_dir):
    space = models.FOREST_SPACE
    depths = [models.MLLIB_MAX_DEPTH if d is None else d for d in space["max_depth"]]
    found = _search_rows(spark, sf_dir, "random_forest")
    rows = []
    for i, (m, bounded, refitted) in enumerate(found):
        inside = (m["numTrees"] in space["n_estimators"] and m["maxDepth"] in depths and m["minInstancesPerNode"] in space["min_samples_leaf"]
                  and m["featureSubsetStrategy"] in space["max_features"])
        rows.append((i, inside, all(m != other for other, _, _ in found[:i]), bounded, refitted))
    return spark.createDataFrame(rows, "draw int, in_space boolean, distinct_map boolean, bounded boolean, best_refitted boolean")


@query("m9_f1_macro_eval", with_views(DOC_SUBJECT_SQL, SC_SQL, """
cf AS (SELECT model, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE label <> 1 AND score >= 0.5) AS fp,
       count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label <> 1 AND score < 0.5) AS tn FROM sc GROUP BY model)""") + f"""
SELECT model, round(({_f1_sql('tp', 'fp', 'fn')} + {_f1_sql('tn', 'fn', 'fp')}) / 2.0, 6) AS f1_macro FROM cf""")
def m9_f1_macro_eval(spark, sf_dir):
    """The evaluator that the searches use, over the three fixed scorers of the evaluation queries."""
    scored = scored_docs(spark, sf_dir).withColumn("prediction", (F.col("score") >= 0.5).cast("double"))
    rows = [(m, models.F1MacroEvaluator().evaluate(scored.where(F.col("model") == m))) for m in SCORERS]
    return spark.createDataFrame(rows, "model string, f1_macro double").withColumn("f1_macro", F.round("f1_macro", 6))


@query("m10_train_all", with_views(VEC_SQL, VEC_SPLIT_SQL) + """
SELECT model, count(*) AS n_test, count(*) FILTER (WHERE label = 1) AS n_positive, true AS metrics_agree
FROM sp, (VALUES ('Logistic Regression'), ('Random Forest'), ('GBT')) m(model) WHERE split = 'test' GROUP BY model""")
def m10_train_all(spark, sf_dir):
    """Metrics of the three families against counts of their scored rows."""
    res = _trained(spark, sf_dir)
    scored = None
    for name, s in res.scored.items():
        one = s.select(F.lit(MODEL_DISPLAY[name]).alias("model"), F.col("label") == 1, F.col("score")).toDF("model", "positive", "score")
        scored = one if scored is None else scored.unionByName(one)
    hit, y = F.col("score") >= F.col("threshold"), F.col("positive")
    cells = {"tp": y & hit, "fp": ~y & hit, "fn": y & ~hit, "tn": ~y & ~hit}
    counted = scored.join(F.broadcast(res.metrics.select("model", "threshold")), "model").groupBy("model").agg(
        F.count("*").alias("n_test"), F.count_if(y).alias("n_positive"), *[F.count_if(c).alias(f"{k}_again") for k, c in cells.items()])
    agree = (F.abs(F.col("accuracy") - (F.col("tp_again") + F.col("tn_again")) / F.col("n_test")) < 1e-9) & F.col("roc_auc").between(0, 1)
    for k in cells:
        agree = agree & (F.col(k) == F.col(f"{k}_again"))
    return counted.join(res.metrics, "model").select("model", "n_test", "n_positive", F.coalesce(agree, F.lit(False)).alias("metrics_agree"))


@query("x1_feature_importance", """
SELECT model, CAST(k AS INTEGER) AS rank, true AS falling, true AS known
FROM (VALUES ('Logistic Regression'), ('Random Forest'), ('GBT')) m(model), range(1, 11) r(k)""")
def x1_feature_importance(spark, sf_dir):
    """The ten most important features of every model: in falling order, none below zero, all of them columns."""
    names = [f"feature_{i}" for i in range(64)]
    top = training.importances(spark, _trained(spark, sf_dir), names, 10)
    order = W.partitionBy("model").orderBy(F.desc("importance"), "feature")
    ranked = top.withColumn("rank", F.row_number().over(order)).withColumn("before", F.lag("importance").over(order))
    return ranked.select("model", "rank", ((F.col("importance") >= 0) & F.coalesce(F.col("before") >= F.col("importance"), F.lit(True))).alias("falling"),
                         F.col("feature").isin(names).alias("known"))


@query("s8_model_roundtrip", with_views(VEC_SQL, VEC_SPLIT_SQL) + """
SELECT vec_id, true AS same FROM sp WHERE split = 'test'""")
def s8_model_roundtrip(spark, sf_dir):
    """Save the fitted forest as a PipelineModel in the shared checkpoint folder, load
    it back, and score the test rows with both; ``same`` must be true on every row."""
    res = _trained(spark, sf_dir)
    pm = models.full_pipeline([], res.fitted["random_forest"])
    path = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    models.save_model(pm, path)
    loaded = models.load_model(path)
    a = models.predict_proba(pm, res.test).select("vec_id", F.col("score").alias("score_saved"))
    b = models.predict_proba(loaded, res.test).select("vec_id", F.col("score").alias("score_loaded"))
    return a.join(b, "vec_id", "left").select("vec_id", F.coalesce(F.col("score_saved") == F.col("score_loaded"), F.lit(False)).alias("same"))


@query("x3_tree_shap")
def x3_tree_shap(spark, sf_dir):
    """Path-dependent Tree SHAP of the fitted forest for every test row (long)."""
    res = _trained(spark, sf_dir)
    return tree_shap.tree_shap(res.test, "vec_id", "features", res.fitted["random_forest"])
