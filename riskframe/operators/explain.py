"""Explainability X1-X9.

Contributions are kept long: (key, feature, phi).  The linear explainer (X2) is pure
column arithmetic; the top-n per row (X8) is a window partitioned by the row key, so
each window group is one row's features (bounded by the feature count).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def feature_importance(spark: SparkSession, model, names: Sequence[str], top_n: int = 10) -> DataFrame | None:
    """Tree importances, else |coefficients|, else None; top n descending.  The
    importance vector is model metadata (one value per feature), not data."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
    elif hasattr(model, "coefficients"):
        vals = [abs(v) for v in model.coefficients.toArray().tolist()]
    else:
        log.warning("model %s does not expose feature importance", type(model).__name__)
        return None
    names = list(names) if names else [f"feature_{i}" for i in range(len(vals))]
    df = spark.createDataFrame(list(zip(names, [float(v) for v in vals])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top_n)


def background_means(df: DataFrame, features: Sequence[str]) -> dict:
    """X6 state: background means (one aggregation, one value per feature)."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).first()
    return {c: float(row[c]) if row[c] is not None else 0.0 for c in features}


def linear_contributions(df: DataFrame, key: str, weights: Mapping[str, float], means: Mapping[str, float]) -> DataFrame:
    """phi_j = w_j * (x_j - mean_j) for every row and feature, long format."""
    structs = [F.struct(F.lit(f).alias("feature"),
                        (F.lit(float(w)) * (F.col(f).cast("double") - F.lit(float(means[f])))).alias("phi"))
               for f, w in weights.items()]
    return df.select(F.col(key), F.inline(F.array(*structs)))


def linear_model_weights(model, names: Sequence[str]) -> dict | None:
    """Weights of a fitted logistic regression by feature name."""
    if isinstance(model, LogisticRegressionModel):
        return dict(zip(names, model.coefficients.toArray().tolist()))
    return None


def explain(df: DataFrame, key: str, model, names: Sequence[str], means: Mapping[str, float]) -> DataFrame | None:
    """X5/X7 dispatcher: linear models -> X2, forests and boosted trees -> X3; others -> None with a warning."""
    if isinstance(model, (RandomForestClassificationModel, GBTClassificationModel)):
        from riskframe.operators.tree_shap import tree_shap

        wide = df.withColumn("_vec", F.array(*[F.col(n).cast("double") for n in names]))
        return tree_shap(wide, key, "_vec", model, names)
    w = linear_model_weights(model, names)
    if w is None:
        log.warning("no explainer for %s", type(model).__name__)
        return None
    return linear_contributions(df, key, w, means)


def shap_summary(phi: DataFrame, top_n: int = 10) -> DataFrame:
    """Features ranked by mean |phi|, top n."""
    g = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    return g.orderBy(F.desc("mean_abs_phi"), "feature").limit(top_n)


def top_contributions(phi: DataFrame, key: str, top_n: int = 5) -> DataFrame:
    """X8 (every row, not only the first): top n by |phi|, signed values kept, with the
    X9 direction label."""
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("phi")), "feature")
    ranked = phi.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
    return ranked.withColumn("direction", direction(F.col("phi")))


def top_linear(df: DataFrame, weights: Mapping[str, float], means: Mapping[str, float], top_n: int = 5) -> F.Column:
    """X8 for a linear model as one expression of the row: its ``top_n`` largest contributions as an array of structs
    (rank, feature, phi, direction), so that ranking a row's features moves no row."""
    phis = [F.struct((-F.abs(phi)).alias("o"), F.lit(f).alias("feature"), phi.alias("phi"))
            for f, w in weights.items()
            for phi in [F.lit(float(w)) * (F.col(f).cast("double") - F.lit(float(means[f])))]]
    top = F.slice(F.array_sort(F.array(*phis)), 1, top_n)
    return F.transform(top, lambda s, i: F.struct((i + 1).cast("int").alias("rank"), s["feature"].alias("feature"), s["phi"].alias("phi"),
                                                  direction(s["phi"]).alias("direction")))


def direction(phi) -> F.Column:
    """X9: "increases" when phi > 0, else "decreases"."""
    return F.when(phi > 0, F.lit("increases")).otherwise(F.lit("decreases"))
