"""From a raw table to saved models that are found by name.

``fit`` chains clean (C11) -> features (F12) -> split (R2) -> encoder fitted on the training part (E4) -> SMOTE or
class weights -> search (M5-M7) for every model family, and saves each one as a PipelineModel (encoder and
classifier) with its explainer state in one registry table.  ``score`` and ``explain`` take raw rows and a model
name.  All of it lies below one folder that the cluster shares.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import clean, encode, explain, models, sample, tree_shap
from riskframe.operators import score as scoring
from riskframe.plans import training
from riskframe.session import cut_lineage
from riskframe.spec import Roles

log = logging.getLogger(__name__)

DEFAULT_MODEL = "random_forest"
_REGISTRY = "name string, path string, encoder string, profile string, means string, base double"


class UnknownModelError(LookupError):
    """No model of this name was saved in the folder."""


@dataclass
class Saved:
    """A fitted model with what scoring and explaining need."""
    name: str
    model: PipelineModel
    encoder: encode.EncoderModel
    profile: clean.Profile
    means: dict  # background mean of every encoded feature (training part)
    base: float  # what the contributions of a row add up from: log-odds (linear, GBT) or probability (forest)


def _base(spark: SparkSession, model, names: list[str], means: dict) -> float:
    if isinstance(model, LogisticRegressionModel):
        weights = explain.linear_model_weights(model, names)
        return float(model.intercept) + sum(w * means[n] for n, w in weights.items())
    return float(tree_shap.expected_value(tree_shap.tree_tables(spark, model)))


def fit(raw: DataFrame, roles: Roles, folder: str, spec: training.SearchSpec | None = None, smote: bool = True, seed: int = 42,
        add_features: Callable[[DataFrame], DataFrame] | None = None) -> training.TrainResult:
    """M10 from a raw table; rows without a usable label are left out and counted in the log.  ``spec`` None is the full search."""
    spark, key, label = raw.sparkSession, roles.key, roles.target
    cleaned, profile = clean.preprocess(raw, roles)
    featured = cut_lineage(add_features(cleaned) if add_features else cleaned)
    unlabelled = featured.where(F.col(label).isNull()).count()
    if unlabelled:
        log.warning("%d rows without a label take no part in training", unlabelled)
    labelled = featured.where(F.col(label).isNotNull())

    # the same draw as in training.prepare: both are hashes of seed and key
    train = sample.split(labelled, key, label, 0.2, seed, stratify=True).where("split = 'train'").drop("split")
    encoder = encode.fit_encoder(train, roles.ordinal, roles.onehot, roles.scaled)
    names = encoder.feature_names()
    wide = encoder.transform(labelled, keep=[key, label])
    vectors = wide.select(key, label, F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias("features_arr"))
    result = training.train_all(vectors, key, label, "features_arr", spec, smote, seed)

    means = explain.background_means(encoder.transform(train), names)
    rows = []
    for name, model in result.fitted.items():
        path = models.save_model(models.full_pipeline(encoder.to_stages(), model), f"{folder.rstrip('/')}/{name}")
        rows.append((name, path, encoder.to_json(), profile.to_json(), json.dumps(means), _base(spark, model, names, means)))
    spark.createDataFrame(rows, _REGISTRY).coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/registry")
    return result


def load(spark: SparkSession, folder: str, name: str = DEFAULT_MODEL) -> Saved:
    """Model and explainer by name."""
    registry = spark.read.schema(_REGISTRY).parquet(f"{folder.rstrip('/')}/registry").collect()
    row = next((r for r in registry if r["name"] == name), None)
    if row is None:
        raise UnknownModelError(f"no model {name!r}; saved are {sorted(r['name'] for r in registry)}")
    return Saved(name, models.load_model(row["path"]), encode.EncoderModel.from_json(row["encoder"]),
                 clean.Profile.from_json(row["profile"]), json.loads(row["means"]), row["base"])


def score(raw: DataFrame, roles: Roles, folder: str, name: str = DEFAULT_MODEL, threshold: float = 0.5,
          add_features: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """P1 with a model by name: the raw columns as they came, Prediction and Probability; no shuffle."""
    saved = load(raw.sparkSession, folder, name)
    return scoring.score_table(raw, roles, saved.model, saved.encoder.input_columns(), add_features, saved.profile, threshold)


def explain_rows(raw: DataFrame, roles: Roles, folder: str, name: str = DEFAULT_MODEL, top_n: int | None = 5,
                 add_features: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """X7 (X8, X9): contributions of the encoded features of raw rows, the ``top_n`` largest of every row or all (None)."""
    saved = load(raw.sparkSession, folder, name)
    cleaned = clean.clip_outliers(clean.apply_impute(clean.clean_raw(raw, roles), saved.profile), saved.profile.fences)
    wide = saved.encoder.transform(add_features(cleaned) if add_features else cleaned, keep=[roles.key])
    names, model = saved.encoder.feature_names(), saved.model.stages[-1]
    weights = explain.linear_model_weights(model, names)
    if weights is not None and top_n is not None:
        return wide.select(roles.key, F.inline(explain.top_linear(wide, weights, saved.means, top_n)))
    phi = explain.explain(wide, roles.key, model, names, saved.means)
    if top_n is None:
        return phi
    return explain.top_contributions(phi, roles.key, top_n).select(roles.key, "rank", "feature", "phi", "direction")
