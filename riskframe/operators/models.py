"""Models and tuning M1-M11 on Spark MLlib.

Training data never leaves the executors: MLlib fits are distributed (tree
aggregation of gradients / histograms), ``CrossValidator`` uses a precomputed,
deterministic ``fold`` column and runs param maps in parallel threads.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Search spaces of the original configuration, mapped to MLlib parameter names.
# (fixed values: grid members as configured)
LOGISTIC_GRID = {"C": [0.01, 0.1, 1, 10], "penalty": ["l1", "l2"]}
FOREST_SPACE = {"n_estimators": [200, 300, 400], "max_depth": [6, 8, 10, None], "min_samples_split": [2, 5],
                "min_samples_leaf": [1, 2], "max_features": ["sqrt", "log2"],
                "class_weight": ["balanced", "balanced_subsample"]}
BOOSTED_GRID = {"n_estimators": [200, 300], "learning_rate": [0.01, 0.05], "max_depth": [5, 6],
                "subsample": [0.7, 0.8], "colsample_bytree": [0.6, 0.7], "min_child_weight": [3], "gamma": [0, 0.1]}
SEARCH = {"logistic_regression": ("grid", 5), "random_forest": ("random", 5), "gbt": ("grid", 5)}
RANDOM_SEARCH_ITER = 30
SEED = 42
MLLIB_MAX_DEPTH = 30  # "no depth limit" maps to MLlib's hard cap


class F1MacroEvaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """M9: macro F1 over classes 0 and 1 (zero_division = 0) in one aggregation.
    (MLlib's ``f1`` metric is support-weighted, not macro.)"""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        y = F.col(self.getLabelCol()) == 1
        p = F.col(self.getPredictionCol()) == 1
        r = dataset.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")).first()

        def f1(a, b, c):
            d = 2 * a + b + c
            return 0.0 if d == 0 else 2 * a / d

        return (f1(r["tp"], r["fp"], r["fn"]) + f1(r["tn"], r["fn"], r["fp"])) / 2.0

    def isLargerBetter(self) -> bool:
        return True


def logistic(features: str = "features", label: str = "label", weight: str | None = None) -> LogisticRegression:
    """M1: no feature standardisation (inputs are already scaled), up to 1000 iterations."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=1000, standardization=False)
    if weight:
        lr.setWeightCol(weight)
    return lr


def forest(features: str = "features", label: str = "label", weight: str | None = None) -> RandomForestClassifier:
    """M2."""
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, seed=SEED)
    if weight:
        rf.setWeightCol(weight)
    return rf


def boosted(features: str = "features", label: str = "label", weight: str | None = None) -> GBTClassifier:
    """M3: gradient-boosted trees with logistic loss (reported as "GBT")."""
    gb = GBTClassifier(featuresCol=features, labelCol=label, lossType="logistic", seed=SEED)
    if weight:
        gb.setWeightCol(weight)
    return gb


ESTIMATORS = {"logistic_regression": logistic, "random_forest": forest, "gbt": boosted}


def _combos(space: Mapping[str, Sequence]) -> list[dict]:
    keys = list(space)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]


def logistic_maps(est: LogisticRegression, n_train: int, grid: Mapping = LOGISTIC_GRID) -> list[dict]:
    """liblinear's C (penalty + C * sum of losses) -> regParam = 1 / (C * n)."""
    maps = []
    for c in _combos(grid):
        maps.append({est.regParam: 1.0 / (float(c["C"]) * max(1, n_train)),
                     est.elasticNetParam: 1.0 if c["penalty"] == "l1" else 0.0})
    return maps


def forest_maps(est: RandomForestClassifier, space: Mapping = FOREST_SPACE) -> list[dict]:
    maps = []
    for c in _combos(space):
        maps.append({est.numTrees: int(c["n_estimators"]),
                     est.maxDepth: MLLIB_MAX_DEPTH if c["max_depth"] is None else int(c["max_depth"]),
                     est.minInstancesPerNode: int(c["min_samples_leaf"]),
                     est.featureSubsetStrategy: c["max_features"]})
    # min_samples_split and class_weight have no separate MLlib knob: collapse duplicates
    uniq, seen = [], set()
    for m in maps:
        key = tuple(sorted((p.name, v) for p, v in m.items()))
        if key not in seen:
            seen.add(key)
            uniq.append(m)
    return uniq


def boosted_maps(est: GBTClassifier, grid: Mapping = BOOSTED_GRID) -> list[dict]:
    maps = []
    for c in _combos(grid):
        maps.append({est.maxIter: int(c["n_estimators"]), est.stepSize: float(c["learning_rate"]),
                     est.maxDepth: int(c["max_depth"]), est.subsamplingRate: float(c["subsample"]),
                     est.featureSubsetStrategy: str(c["colsample_bytree"]),
                     est.minInstancesPerNode: int(c["min_child_weight"]), est.minInfoGain: float(c["gamma"])})
    return maps


def sample_maps(maps: list[dict], n_iter: int, seed: int = SEED) -> list[dict]:
    """M6: random search = n_iter maps drawn without replacement (driver-side, tiny)."""
    if n_iter >= len(maps):
        return list(maps)
    return random.Random(seed).sample(maps, n_iter)


def search(estimator, train: DataFrame, maps: list[dict] | None, fold_col: str = "fold",
           label: str = "label", parallelism: int = 4, folds: int = 3):
    """M5/M7: cross-validated search over ``maps`` with the precomputed fold column (0 to ``folds`` - 1) and
    the F1-macro evaluator; the best map is refit on all training rows.  ``maps`` None
    or one map = fixed parameters (no search)."""
    if not maps or len(maps) == 1:
        est = estimator.copy(maps[0]) if maps else estimator
        return est.fit(train.drop(fold_col) if fold_col in train.columns else train), None
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps,
                        evaluator=F1MacroEvaluator(labelCol=label), foldCol=fold_col,
                        numFolds=folds, parallelism=parallelism, seed=SEED)
    model = cv.fit(train)
    return model.bestModel, list(model.avgMetrics)


def predict_proba(model, df: DataFrame, prob_col: str = "probability", out: str = "score") -> DataFrame:
    """Model label and P(class 1) as a double column."""
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array(F.col(prob_col))[1])


def full_pipeline(encoder_stages: list, model) -> PipelineModel:
    """Encoder stages + fitted classifier as one persistable PipelineModel."""
    return PipelineModel(stages=list(encoder_stages) + [model])


def save_model(model: PipelineModel, path: str) -> str:
    """S8 save (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """S8 load."""
    return PipelineModel.load(path)


__all__ = ["F1MacroEvaluator", "ESTIMATORS", "search", "sample_maps", "logistic_maps", "forest_maps", "boosted_maps",
           "predict_proba", "full_pipeline", "save_model", "load_model"]
