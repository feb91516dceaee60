"""Scoring P1-P6.  Scoring is one narrow plan (no shuffle): clean -> features ->
align -> encode -> model -> label/probability, executed by every executor on its own
rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import sigmoid
from riskframe.functions.ranking import modes, quantile_dict
from riskframe.operators import clean, encode
from riskframe.spec import Roles


def label_and_probability(df: DataFrame, prob: Column, threshold: float = 0.5, decimals: int = 4,
                          positive: str = "Yes", negative: str = "No") -> DataFrame:
    """P1 tail: Prediction (positive if p >= threshold) and Probability (half-even
    rounded)."""
    return df.withColumns({
        "Prediction": F.when(prob >= F.lit(threshold), F.lit(positive)).otherwise(F.lit(negative)),
        "Probability": F.bround(prob, decimals),
    })


def linear_probability(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """sigmoid(intercept + sum w_j x_j): a fixed-coefficient scorer as an expression."""
    z = F.lit(float(intercept))
    for f, w in weights.items():
        z = z + F.lit(float(w)) * F.col(f).cast("double")
    return sigmoid(z)


def score_table(raw: DataFrame, roles: Roles, model: PipelineModel | Callable[[DataFrame], DataFrame],
                feature_columns: Sequence[str], add_features: Callable[[DataFrame], DataFrame] | None = None,
                profile: clean.Profile | None = None, threshold: float = 0.5) -> DataFrame:
    """Batch or stream score a raw table; the input columns are returned as they came and Prediction /
    Probability appended.  ``model`` is a fitted PipelineModel, or a function that adds the probability as
    column ``_p``.  ``profile`` (optional) applies the fitted imputation and clipping to what is scored."""
    # the row as it came travels beside the working columns
    held = raw.withColumn("_raw", F.struct(*raw.columns))
    cleaned = clean.clean_raw(held, roles)
    if roles.target and roles.target in cleaned.columns:
        cleaned = cleaned.drop(roles.target)
    if profile is not None:
        cleaned = clean.clip_outliers(clean.apply_impute(cleaned, profile), profile.fences)
    feats = add_features(cleaned) if add_features else cleaned
    missing = [c for c in feature_columns if c not in feats.columns]
    if missing:
        raise encode.MissingColumnsError(f"the input has no column {sorted(missing)}")
    if callable(model):
        scored = model(feats)
    else:
        scored = model.transform(feats).withColumn("_p", vector_to_array(F.col("probability"))[1])
    out = label_and_probability(scored, F.col("_p"), threshold)
    kept = [c for c in raw.columns if c not in ("Prediction", "Probability")]
    return out.select(*[F.col("_raw")[c].alias(c) for c in kept], "Prediction", "Probability")


def preview(scored: DataFrame, key: str, n: int = 10) -> DataFrame:
    """P5: first n (Prediction, Probability) in key order."""
    return scored.orderBy(key).select(key, "Prediction", "Probability").limit(n)


def compute_defaults(raw: DataFrame, numerical: Sequence[str], categorical: Sequence[str],
                     ordinal: Sequence[str]) -> dict:
    """Medians of numerical fields, modes of categorical fields, int(median) of
    ordinal fields, from the raw table (one small summary, collected)."""
    out = {}
    if numerical or ordinal:
        q = quantile_dict(raw, list(numerical) + list(ordinal), [0.5])
        for c in numerical:
            out[c] = q.get((c, 0.5))
        for c in ordinal:
            v = q.get((c, 0.5))
            out[c] = None if v is None else int(v)
    if categorical:
        out.update({r["column"]: r["value"] for r in modes(raw, categorical).collect()})
    return out


def complete_records(partial: DataFrame, defaults: Mapping[str, object], dtypes: Mapping[str, str] | None = None) -> DataFrame:
    """Fill absent or null fields of partial records from the defaults (literals;
    no join)."""
    out = {}
    for c, v in defaults.items():
        lit = F.lit(v)
        if dtypes and c in dtypes:
            lit = lit.cast(dtypes[c])
        out[c] = F.coalesce(F.col(c), lit) if c in partial.columns else lit
    return partial.withColumns(out) if out else partial
