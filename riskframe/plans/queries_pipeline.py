"""Registered queries: raw table -> saved models -> scores (P2) and explanations (X6, X7) by model name.

Each query fits its models itself, every family with one setting (the search is what m5 and m6 are about); the
models are used on all documents, also on those without a label.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import sigmoid
from riskframe.plans import pipeline
from riskframe.plans.catalog import DOC_SUBJECT_SQL, query, r6, with_views
from riskframe.plans.subjects import DOC_ROLES, doc_subject
from riskframe.plans.training import SearchSpec
from riskframe.session import cut_lineage, ensure_checkpoint_dir

NAMES = ("logistic_regression", "random_forest", "gbt")
ONE_SETTING = SearchSpec(
    logistic={"C": [1], "penalty": ["l2"]},
    forest={"n_estimators": [50], "max_depth": [6], "min_samples_split": [2], "min_samples_leaf": [1],
            "max_features": ["sqrt"], "class_weight": ["balanced"]},
    forest_iter=1,
    boosted={"n_estimators": [20], "learning_rate": [0.1], "max_depth": [3], "subsample": [0.8],
             "colsample_bytree": [0.7], "min_child_weight": [3], "gamma": [0]})

ALL_DOCS_SQL = DOC_SUBJECT_SQL.replace("doc_subject AS", "all_docs AS").replace("JOIN labels", "LEFT JOIN labels")
MODELS_SQL = "(VALUES " + ", ".join(f"('{n}')" for n in NAMES) + ") m(model)"


def _subject(spark, sf_dir, how: str = "inner") -> DataFrame:
    """``doc_subject``, cut from the texts that its columns count in: fits and scores read it many times."""
    return cut_lineage(doc_subject(spark, sf_dir, how))


def _fitted(spark, sf_dir, smote: bool) -> str:
    folder = os.path.join(ensure_checkpoint_dir(spark), f"named-models-{uuid.uuid4().hex}")
    pipeline.fit(_subject(spark, sf_dir), DOC_ROLES, folder, ONE_SETTING, smote=smote)
    return folder


def _each(make) -> DataFrame:
    return reduce(DataFrame.unionByName, [make(n).withColumn("model", F.lit(n)) for n in NAMES])


@query("p2_score_by_name", with_views(ALL_DOCS_SQL) + f"""
SELECT a.*, model, true AS consistent FROM all_docs a, {MODELS_SQL}""")
def p2_score_by_name(spark, sf_dir):
    """Every document scored by every saved model: input columns untouched, and label and probability fit together."""
    raw, folder = _subject(spark, sf_dir, "left"), _fitted(spark, sf_dir, smote=True)
    p, yes = F.col("Probability"), F.col("Prediction") == "Yes"
    fits = p.between(0, 1) & ((yes & (p >= 0.5)) | ((F.col("Prediction") == "No") & (p <= 0.5)))
    return _each(lambda n: pipeline.score(raw, DOC_ROLES, folder, n)).select(*raw.columns, "model", F.coalesce(fits, F.lit(False)).alias("consistent"))


@query("x6_explainer_by_name")
def x6_explainer_by_name(spark, sf_dir):
    """Background mean of every feature and the base value, as loaded by name."""
    folder = _fitted(spark, sf_dir, smote=False)
    rows = [(n, f, float(m), float(s.base)) for n in NAMES for s in [pipeline.load(spark, folder, n)] for f, m in s.means.items()]
    return spark.createDataFrame(rows, "model string, feature string, mean double, base double").select("model", "feature", r6("mean").alias("mean"), r6("base").alias("base"))


@query("x7_explain_raw_rows", with_views(ALL_DOCS_SQL) + f"""
SELECT doc_id, model, true AS additive FROM all_docs a, {MODELS_SQL}""")
def x7_explain_raw_rows(spark, sf_dir):
    """Contributions of every document under every saved model: with the base value they add up to its score."""
    raw, folder = _subject(spark, sf_dir, "left"), _fitted(spark, sf_dir, smote=False)

    def one(name: str) -> DataFrame:
        base = F.lit(pipeline.load(spark, folder, name).base)
        total = pipeline.explain_rows(raw, DOC_ROLES, folder, name, top_n=None).groupBy("doc_id").agg(F.sum("phi").alias("phi"))
        out = base + F.col("phi")
        out = out if name == "random_forest" else sigmoid(out)
        scored = pipeline.score(raw, DOC_ROLES, folder, name).select("doc_id", "Probability")
        # probabilities are rounded to four digits
        return scored.join(total, "doc_id", "left").select("doc_id", F.coalesce(F.abs(out - F.col("Probability")) <= 6e-5, F.lit(False)).alias("additive"))

    return _each(one)
