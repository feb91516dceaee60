"""Train-all flow (M10): split -> SMOTE (train only) -> folds -> search + refit for
three model families -> score the test part -> metrics, importances.

Input is an encoded table: key, label and an ``array<double>`` feature column (the
encoder's output, or raw numeric vectors).  All heavy steps are Spark jobs; the
driver only loops over the three model families and their (small) param maps.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import evaluate as ev
from riskframe.operators import explain, models, sample
from riskframe.session import cut_lineage
from riskframe.spec import MODEL_DISPLAY

#: Rows of the training part that are worth a partition, rows that fill one, and partitions up to which the first counts.
PART_ROWS = (2_000, 20_000)
PARTS = 16


#: Model families, in the order of training.
FAMILIES = ("logistic_regression", "random_forest", "gbt")


@dataclass
class SearchSpec:
    logistic: dict = field(default_factory=lambda: dict(models.LOGISTIC_GRID))
    forest: dict = field(default_factory=lambda: dict(models.FOREST_SPACE))
    forest_iter: int = models.RANDOM_SEARCH_ITER
    boosted: dict = field(default_factory=lambda: dict(models.BOOSTED_GRID))
    folds: int = 5
    parallelism: int = 4
    boosted_parallelism: int = 16  # boosted fits are chains of short jobs over one small tree each


@dataclass
class Family:
    """One model family: its searched maps, their mean scores (None for a single map), the refitted best and its test scores."""

    maps: list
    cv_metrics: list | None
    fitted: object
    scored: DataFrame
    metrics: DataFrame


class ByFamily(Mapping):
    """One field of every family, by name; a family is searched when something of it is first read."""

    def __init__(self, result: TrainResult, what: str):
        self._result, self._what = result, what

    def __getitem__(self, name: str):
        return getattr(self._result.family(name), self._what)

    def __iter__(self):
        return iter(FAMILIES)

    def __len__(self) -> int:
        return len(FAMILIES)


class TrainResult:
    """Both parts, and for every family its fields by name.  A family is searched once, whole, when it is first read: who reads the
    search of one family does not wait for the others."""

    def __init__(self, train: DataFrame, test: DataFrame, search: Callable[[str], Family]):
        self.train, self.test, self._search, self._families = train, test, search, {}
        self.fitted, self.cv_metrics, self.scored = ByFamily(self, "fitted"), ByFamily(self, "cv_metrics"), ByFamily(self, "scored")
        self.maps = ByFamily(self, "maps")  # parameter maps that were searched, in the order of cv_metrics

    def family(self, name: str) -> Family:
        if name not in FAMILIES:
            raise KeyError(name)
        if name not in self._families:
            self._families[name] = self._search(name)
        return self._families[name]

    @property
    def metrics(self) -> DataFrame:
        """Test metrics of all families."""
        return reduce(DataFrame.unionByName, [self.family(name).metrics for name in FAMILIES])


def partitions(n: int) -> int:
    """Partitions of ``n`` training rows, the same on every cluster: fits are many short jobs, whose time is that of starting tasks."""
    least, full = PART_ROWS
    return max(1, min(math.ceil(n / least), max(PARTS, math.ceil(n / full))))


def prepare(df: DataFrame, key: str, label: str, vec: str, smote: bool = True, seed: int = 42,
            folds: int = 5, test_size: float = 0.2):
    """R2 split, R4 SMOTE on the training part only, M8 folds; returns (train, test)
    with a ``features`` vector column.  Both are cut from the plans that made them: every task of a fit would carry these
    plans and report all their metrics to the driver."""
    parted = sample.split(df.select(key, label, vec), key, label, test_size, seed, stratify=True)
    train = parted.where(F.col("split") == "train").drop("split")
    test = parted.where(F.col("split") == "test").drop("split")
    if smote:
        train = sample.smote(train, key, label, vec, k=5, seed=seed)
    else:
        train = train.withColumn("is_synthetic", F.lit(False))
    train = cut_lineage(train)
    n_parts = partitions(train.count())
    train = sample.assign_folds(train, key, label, folds, seed)
    to_vec = array_to_vector(F.col(vec)).alias("features")
    if smote:
        train = train.withColumn("weight", F.lit(1.0))
    else:  # classes as they are: weights balance them instead
        train = sample.balanced_weights(train, label)
    train = train.repartition(n_parts, key, vec).sortWithinPartitions(key, vec, label, "is_synthetic", "fold")
    train = train.select(key, F.col(label).cast("double").alias("label"), to_vec, "fold", "is_synthetic", "weight")
    test = test.select(key, F.col(label).cast("double").alias("label"), to_vec)
    return cut_lineage(train).cache(), cut_lineage(test).cache()


def train_all(df: DataFrame, key: str, label: str, vec: str, spec: SearchSpec | None = None,
              smote: bool = True, seed: int = 42) -> TrainResult:
    """M10; ``spec`` None is the full search.  The parts are made at once, the families of the result when they are read."""
    spec = spec or SearchSpec()
    train, test = prepare(df, key, label, vec, smote, seed, spec.folds)
    n_train = train.count()

    def search(name: str) -> Family:
        est, parallelism = models.ESTIMATORS[name](), spec.parallelism
        if not smote:
            est = est.setWeightCol("weight")
        if name == "logistic_regression":
            maps = models.logistic_maps(est, n_train, spec.logistic)
        elif name == "random_forest":
            maps = models.sample_maps(models.forest_maps(est, spec.forest), spec.forest_iter, seed)
        else:
            maps, parallelism = models.boosted_maps(est, spec.boosted), spec.boosted_parallelism
        best, avg = models.search(est, train.drop("is_synthetic"), maps, parallelism=parallelism, folds=spec.folds)
        s = models.predict_proba(best, test).select(key, "label", "prediction", "score")
        return Family(maps, avg, best, s, ev.evaluate_model(s, MODEL_DISPLAY[name]))

    return TrainResult(train, test, search)


def importances(spark, result: TrainResult, names, top_n: int = 10) -> DataFrame:
    """X1 for every fitted model."""
    out = None
    for name, m in result.fitted.items():
        imp = explain.feature_importance(spark, m, names, top_n)
        if imp is None:
            continue
        imp = imp.select(F.lit(MODEL_DISPLAY[name]).alias("model"), "*")
        out = imp if out is None else out.unionByName(imp)
    return out
