"""Path-dependent Tree SHAP for MLlib random forests and GBT classifiers.

The fitted trees are read from the model's own saved node table (``<path>/data``:
treeID, nodeData{id, prediction, impurityStats, rawCount, leftChild, rightChild,
split}), turned into per-tree arrays (bounded by the model size, not the data) and
broadcast.  Rows are explained where they live, in ``mapInPandas`` (Arrow batches),
and come out long: (key, feature, phi).

Units: forests explain P(class 1) (mean over trees of the leaf's class-1 share); GBT
explains the log-odds 2 * sum_t w_t * tree_t(x) (MLlib's probability is
sigmoid(2 * margin)).  Additivity: sum(phi) + expected_value = model output.
Algorithm: Lundberg, Erion & Lee, "Consistent Individualized Feature Attribution for
Tree Ensembles" (arXiv:1802.03888), Algorithm 2.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir


def tree_tables(spark: SparkSession, model) -> dict:
    """Per-tree node arrays + tree weights + output kind, from the saved model."""
    if isinstance(model, RandomForestClassificationModel):
        kind = "forest"
    elif isinstance(model, GBTClassificationModel):
        kind = "gbt"
    else:
        raise TypeError(f"Tree SHAP supports forest and GBT classifiers, not {type(model).__name__}")
    path = os.path.join(ensure_checkpoint_dir(spark), f"shap-model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data")).select("treeID", "nodeData.*").collect()
    weights = {r[0]: float(r[2]) for r in spark.read.parquet(os.path.join(path, "treesMetadata")).collect()}
    trees = {}
    for r in nodes:
        trees.setdefault(r["treeID"], []).append(r)
    out = []
    for tid in sorted(trees):
        rows = sorted(trees[tid], key=lambda r: r["id"])
        n = len(rows)
        left = np.full(n, -1, dtype=np.int64)
        right = np.full(n, -1, dtype=np.int64)
        feat = np.full(n, -1, dtype=np.int64)
        thr = np.zeros(n)
        cats: list = [None] * n
        value = np.zeros(n)
        cover = np.zeros(n)
        for r in rows:
            i = r["id"]
            left[i], right[i] = r["leftChild"], r["rightChild"]
            stats = list(r["impurityStats"] or [])
            if kind == "forest":
                tot = float(sum(stats))
                value[i] = (stats[1] / tot) if tot > 0 and len(stats) > 1 else 0.0
                cover[i] = tot
            else:
                value[i] = float(r["prediction"])
                cover[i] = float(stats[0]) if stats else float(r["rawCount"])
            sp = r["split"]
            if left[i] >= 0 and sp is not None:
                feat[i] = sp["featureIndex"]
                vals = list(sp["leftCategoriesOrThreshold"] or [])
                if sp["numCategories"] is not None and sp["numCategories"] >= 0:
                    cats[i] = set(vals)
                else:
                    thr[i] = vals[0]
        out.append({"left": left, "right": right, "feat": feat, "thr": thr, "cats": cats, "value": value,
                    "cover": cover, "weight": weights.get(tid, 1.0)})
    return {"kind": kind, "trees": out}


def _tree_expected(t: dict) -> float:
    leaves = t["left"] < 0
    return float((t["value"][leaves] * t["cover"][leaves]).sum() / t["cover"][0])


def expected_value(tables: dict) -> float:
    trees = tables["trees"]
    if tables["kind"] == "forest":
        return sum(t["weight"] * _tree_expected(t) for t in trees) / sum(t["weight"] for t in trees)
    return 2.0 * sum(t["weight"] * _tree_expected(t) for t in trees)


def _leaf_paths(t: dict) -> list[tuple[int, list[int], np.ndarray, list[list[tuple[int, bool]]]]]:
    """For every leaf: its node, the features on its path, the share of cover that follows the path at each feature's
    splits, and these splits (node, whether the path goes left)."""
    left, right, feat, cover = (t[k] for k in ("left", "right", "feat", "cover"))
    out, open_ = [], [(0, {})]
    while open_:
        node, path = open_.pop()
        if left[node] < 0:
            out.append((node, list(path), np.array([z for z, _ in path.values()]), [at for _, at in path.values()]))
            continue
        f = int(feat[node])
        z, at = path.get(f, (1.0, []))
        for child, goes_left in ((left[node], True), (right[node], False)):
            open_.append((int(child), path | {f: (z * cover[child] / cover[node], [*at, (node, goes_left)])}))
    return out


def _weights(ones: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Contribution per unit of a leaf's value of each path feature, for rows of 0/1: does the row follow the path there?
    (EXTEND over the whole path, then the UNWOUND sum of every feature, all rows at a time.)"""
    n, d = ones.shape
    w = np.zeros((d + 1, n))
    w[0] = 1.0
    for ud in range(1, d + 1):
        po, pz = ones[:, ud - 1], z[ud - 1]
        for i in range(ud - 1, -1, -1):
            w[i + 1] += po * w[i] * (i + 1) / (ud + 1)
            w[i] = pz * w[i] * (ud - i) / (ud + 1)
    out = np.empty((n, d))
    for k in range(d):
        follows, pz = ones[:, k] != 0, z[k]
        nxt, total = w[d].copy(), np.zeros(n)
        for i in range(d - 1, -1, -1):
            tmp = nxt * (d + 1) / (i + 1)
            total += np.where(follows, tmp, w[i] / pz * (d + 1) / (d - i))
            nxt = w[i] - tmp * pz * (d - i) / (d + 1)
        out[:, k] = total * (ones[:, k] - pz)
    return out


def _bits(patterns: np.ndarray, d: int) -> np.ndarray:
    return (patterns[:, None] >> np.arange(d) & 1).astype(float)


#: Up to so many path features, a leaf's contributions are kept for all patterns; longer paths take those that a batch has.
TABLE_FEATURES = 8


def _leaf_tables(tables: dict) -> list[list[tuple]]:
    """What ``shap_matrix`` needs of every tree's leaves, made once per task and kept with the tables."""
    if "leaves" not in tables:
        tables["leaves"] = [[(f, z, at, t["value"][node], _weights(_bits(np.arange(1 << len(f)), len(f)), z) if len(f) <= TABLE_FEATURES else None)
                             for node, f, z, at in _leaf_paths(t) if f] for t in tables["trees"]]
    return tables["leaves"]


def shap_matrix(tables: dict, X: np.ndarray) -> np.ndarray:
    """phi for a batch of rows (rows x features).  A row's contributions at a leaf depend only on which path features it
    follows, so each leaf looks them up for all rows of the batch."""
    trees = tables["trees"]
    if tables["kind"] == "forest":
        wsum = sum(t["weight"] for t in trees)
        scales = [t["weight"] / wsum for t in trees]
    else:
        scales = [2.0 * t["weight"] for t in trees]
    columns = np.ascontiguousarray(X.T)
    out = np.zeros(columns.shape, dtype=float)
    for t, leaves, s in zip(trees, _leaf_tables(tables), scales, strict=True):
        goes_left = {int(i): np.isin(columns[f], list(t["cats"][i])) if t["cats"][i] is not None else columns[f] <= t["thr"][i]
                     for i, f in enumerate(t["feat"]) if t["left"][i] >= 0}
        for features, z, splits, value, table in leaves:
            pattern = np.zeros(X.shape[0], dtype=np.int64)
            for j, at in enumerate(splits):
                follows = np.ones(X.shape[0], dtype=bool)
                for node, is_left in at:
                    follows &= goes_left[node] == is_left
                pattern |= follows.astype(np.int64) << j
            if table is None:
                found, pattern = np.unique(pattern, return_inverse=True)
                table = _weights(_bits(found, len(features)), z)
            for j, f in enumerate(features):
                out[f] += (s * value * table[:, j])[pattern]
    return out.T


def tree_shap(df: DataFrame, key: str, vec: str, model, names: Sequence[str] | None = None) -> DataFrame:
    """(key, feature, phi) for every row of ``df`` (``vec`` is array<double> or a
    vector column)."""
    spark = df.sparkSession
    tables = tree_tables(spark, model)
    bc = spark.sparkContext.broadcast(tables)
    col = F.col(vec)
    if dict(df.dtypes)[vec] != "array<double>":
        from pyspark.ml.functions import vector_to_array
        col = vector_to_array(col)
    src = df.select(F.col(key).alias("key"), col.alias("x"))
    key_type = dict(src.dtypes)["key"]

    def run(batches):
        tb = bc.value
        for pdf in batches:
            if not pdf.empty:
                yield pd.DataFrame({"key": pdf["key"], "phi": list(shap_matrix(tb, np.vstack(pdf["x"].to_numpy()).astype(float)))})

    phi = src.mapInPandas(run, f"key {key_type}, phi array<double>")
    # names are added by Spark: from Python come only the numbers
    known = F.array(*[F.lit(n) for n in names]) if names else F.transform("phi", lambda _, i: F.concat(F.lit("feature_"), i.cast("string")))
    long = phi.select("key", F.posexplode("phi").alias("_i", "phi"), known.alias("_names"))
    return long.select(F.col("key").alias(key), F.get("_names", F.col("_i")).alias("feature"), "phi")
