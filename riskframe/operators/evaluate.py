"""Evaluation V1-V17 over any scored table (label 0/1, score in [0, 1]).

* V1 threshold sweep: one pass.  Each row gets the number of grid thresholds it
  passes (a binary-search expression), then (bucket, label) counts (<= 81 x 2 rows),
  suffix sums over that tiny table give all 80 confusion matrices at once.
* V7 ROC-AUC and V15 ROC points: exact with ties.  Rows collapse to distinct scores
  (partial aggregation), cumulative counts are prefix sums over range partitions
  (offsets from the partitions' totals), so no window holds the whole table.
* Metrics (V2-V9) are conditional counts in one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.exprs import sorted_bucket
from riskframe.functions.ranking import null_safe_join as _null_safe_join
from riskframe.session import cut_lineage

# The sweep grid is numpy.arange(0.1, 0.9, 0.01): 80 doubles, most of them not the
# two-decimal numbers they look like; the chosen one is rounded to 2 decimals.
THRESHOLDS: list[float] = [float(t) for t in np.arange(0.1, 0.9, 0.01)]
THRESHOLDS_ROUNDED: list[float] = [round(t, 2) for t in THRESHOLDS]
DEFAULT_THRESHOLD = 0.5


def _safe_div(a: Column, b: Column) -> Column:
    """a / b, 0 when b == 0 (zero_division = 0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _safe_div(F.lit(2) * tp, F.lit(2) * tp + fp + fn)


def _score_counts(scored: DataFrame, label: str, score: str, group: Sequence[str]) -> DataFrame:
    """Positives and negatives of every distinct score: all that V1, V2, V7 and V15 need of the rows."""
    y = F.col(label).cast("long")
    return scored.where(F.col(score).isNotNull()).groupBy(*group, F.col(score).cast("double").alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def _sweep(counts: DataFrame, thresholds: Sequence[float], group: Sequence[str]) -> DataFrame:
    """Confusion counts at every threshold from the counts of distinct scores."""
    k, parts = len(thresholds), list(group)
    b = sorted_bucket(F.col("s"), thresholds)  # number of thresholds <= score
    held = counts.groupBy(*parts, b.alias("bucket")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # at most k + 1 rows a group from here on
    spine = held.select(*parts).distinct() if parts else counts.sparkSession.range(1).select()
    spine = spine.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(k))))
    full = _null_safe_join(spine, held, [*parts, "bucket"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*parts).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy(*parts)
    sfx = full.select(*parts, "bucket", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                      F.sum("pos").over(tot).alias("P"), F.sum("neg").over(tot).alias("N")).where("bucket > 0")
    fn = F.col("P") - F.col("tp")
    tn = F.col("N") - F.col("fp")
    f1m = (_f1(F.col("tp"), F.col("fp"), fn) + _f1(tn, fn, F.col("fp"))) / F.lit(2.0)
    threshold = F.element_at(F.array(*[F.lit(float(t)) for t in thresholds]), F.col("bucket"))
    return sfx.select(*parts, (F.col("bucket") - 1).alias("idx"), threshold.alias("threshold"), tn.alias("tn"), "fp", fn.alias("fn"), "tp", f1m.alias("f1_macro"))


def threshold_sweep(scored: DataFrame, label: str = "label", score: str = "score",
                    thresholds: Sequence[float] = THRESHOLDS, group: Sequence[str] = ()) -> DataFrame:
    """V1 (all thresholds): (*group, idx, threshold, tn, fp, fn, tp, f1_macro)."""
    return _sweep(_score_counts(scored, label, score, group), thresholds, group)


def best_threshold(sweep: DataFrame, rounded: Sequence[float] = THRESHOLDS_ROUNDED, group: Sequence[str] = ()) -> DataFrame:
    """V1 (choice): highest F1-macro, ties -> lowest threshold, default 0.5 when every
    F1 is 0; rounded to 2 decimals.  One row (*group, threshold, f1_macro) per group."""
    top = sweep.groupBy(*group).agg(F.max(F.struct("f1_macro", (-F.col("idx")).alias("i"))).alias("m")).where("m is not null")
    at = F.element_at(F.array(*[F.lit(float(r)) for r in rounded]), (1 - F.col("m.i")).cast("int"))
    return top.select(*group, F.when(F.col("m.f1_macro") > 0, at).otherwise(F.lit(DEFAULT_THRESHOLD)).alias("threshold"), F.col("m.f1_macro").alias("f1_macro"))


def tuned_threshold(scored: DataFrame, label: str = "label", score: str = "score") -> float:
    row = best_threshold(threshold_sweep(scored, label, score)).first()
    return float(row["threshold"]) if row else DEFAULT_THRESHOLD


def confusion_counts(scored: DataFrame, threshold: float | Column, label: str = "label", score: str = "score",
                     group: Sequence[str] = ()) -> DataFrame:
    """V2: tn, fp, fn, tp at ``p >= threshold`` in one aggregation (per group)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score) >= t
    y = F.col(label) == 1
    aggs = [F.count_if(~y & ~pred).alias("tn"), F.count_if(~y & pred).alias("fp"),
            F.count_if(y & ~pred).alias("fn"), F.count_if(y & pred).alias("tp")]
    return scored.groupBy(*group).agg(*aggs)


def metrics_from_counts(c: DataFrame, class_names: tuple[str, str] = ("negative", "positive")) -> DataFrame:
    """V3-V6, V8, V9 from (tn, fp, fn, tp) columns (other columns pass through)."""
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p0, p1 = _safe_div(tn, tn + fn), _safe_div(tp, tp + fp)
    r0, r1 = _safe_div(tn, tn + fp), _safe_div(tp, tp + fn)
    two_by_two = ((tn + fp + fn) > 0) & ((tp + fn + fp) > 0)
    fpr = F.when(two_by_two, _safe_div(fp, fp + tn)).otherwise(F.lit(0.0))
    fnr = F.when(two_by_two, _safe_div(fn, fn + tp)).otherwise(F.lit(0.0))
    neg, pos = class_names
    dominant = (F.when(~two_by_two, F.lit("N/A"))
                .when(fpr > fnr, F.lit(f"Class 0 ({neg} predicted as {pos})"))
                .otherwise(F.lit(f"Class 1 ({pos} predicted as {neg})")))
    return c.withColumns({
        "accuracy": _safe_div(tn + tp, n),
        "f1_macro": (_f1(tp, fp, fn) + _f1(tn, fn, fp)) / F.lit(2.0),
        "precision": (p0 + p1) / F.lit(2.0),
        "recall": (r0 + r1) / F.lit(2.0),
        "fpr": fpr, "fnr": fnr, "dominant_error": dominant,
    })


def _ranged(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Distinct scores range-partitioned by (group, score), with the number of their partition.  Written once: the bounds of
    a range partitioning are drawn from a sample, and totals and offsets must see the same ones."""
    return cut_lineage(counts.repartitionByRange(*group, "s").withColumn("_part", F.spark_partition_id()))


def _prefix_sums(ranged: DataFrame, group: Sequence[str]) -> DataFrame:
    """Distinct scores with inclusive cumulative pos/neg counts (ascending score) and the group totals P, N: sums inside
    every partition, and offsets from the totals of the partitions (groups x partitions rows at most)."""
    parts = list(group)
    inside = Window.partitionBy(*parts, "_part").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*parts).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parts)
    totals = ranged.groupBy(*parts, "_part").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    offsets = totals.select(*parts, "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("_p", "_n")],
                            F.sum("_p").over(whole).alias("P"), F.sum("_n").over(whole).alias("N"))
    local = ranged.select("*", F.sum("pos").over(inside).alias("_lp"), F.sum("neg").over(inside).alias("_ln"))
    return _null_safe_join(local, offsets, [*parts, "_part"]).select(
        *parts, "s", "pos", "neg", (F.col("_p0") + F.col("_lp")).alias("cum_pos"), (F.col("_n0") + F.col("_ln")).alias("cum_neg"), "P", "N")


def _cumulative(scored: DataFrame, label: str, score: str, group: Sequence[str]) -> DataFrame:
    return _prefix_sums(_ranged(_score_counts(scored, label, score, group), group), group)


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score", group: Sequence[str] = ()) -> DataFrame:
    """V7: exact ROC-AUC with ties = P(score_pos > score_neg) + 0.5 P(equal)."""
    return _auc(_cumulative(scored, label, score, group), group)


def _auc(c: DataFrame, group: Sequence[str]) -> DataFrame:
    above = F.col("P") - F.col("cum_pos")  # positives with a strictly higher score
    term = F.col("neg").cast("double") * (above.cast("double") + F.lit(0.5) * F.col("pos").cast("double"))
    agg = c.groupBy(*group).agg(F.sum(term).alias("_num"), F.first("P").alias("P"), F.first("N").alias("N"))
    return agg.select(*group, F.when((F.col("P") == 0) | (F.col("N") == 0), F.lit(None))
                      .otherwise(F.col("_num") / (F.col("P").cast("double") * F.col("N").cast("double")))
                      .alias("roc_auc"))


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score", group: Sequence[str] = ()) -> DataFrame:
    """One ROC point per distinct score (threshold, fpr, tpr) plus the origin with
    threshold +inf.  (Collinear intermediate points are kept.)"""
    c = _cumulative(scored, label, score, group)
    tp = F.col("P") - F.col("cum_pos") + F.col("pos")
    fp = F.col("N") - F.col("cum_neg") + F.col("neg")
    pts = c.select(*group, F.col("s").alias("threshold"), _safe_div(fp, F.col("N")).alias("fpr"),
                   _safe_div(tp, F.col("P")).alias("tpr"))
    origin = pts.select(*group).distinct() if group else scored.sparkSession.range(1).select()
    origin = origin.select(*group, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def class_report(c: DataFrame) -> DataFrame:
    """Per-class precision / recall / F1 / support plus macro and weighted averages,
    from a one-row (tn, fp, fn, tp) table."""
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, tp + fn
    p0, p1 = _safe_div(tn, tn + fn), _safe_div(tp, tp + fp)
    r0, r1 = _safe_div(tn, tn + fp), _safe_div(tp, tp + fn)
    f0, f1 = _f1(tn, fn, fp), _f1(tp, fp, fn)
    n = (s0 + s1).cast("double")

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
                        s.cast("long").alias("support"))

    rows = [row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
            row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
            row("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
                _safe_div(f0 * s0 + f1 * s1, n), s0 + s1)]
    return c.select(F.inline(F.array(*rows)))


def evaluate_models(scored: DataFrame, group: str = "model", label: str = "label", score: str = "score",
                    class_names: tuple[str, str] = ("negative", "positive")) -> DataFrame:
    """One metrics row for every model: tune its threshold on this table, recompute the confusion counts at the rounded
    threshold, add ROC-AUC.  The rows are read once, for the counts of distinct scores; all models share every step."""
    held = _ranged(_score_counts(scored, label, score, [group]), [group])
    best = best_threshold(_sweep(held, THRESHOLDS, [group]), group=[group]).select(group, "threshold")
    at = _sweep(held, THRESHOLDS_ROUNDED, [group]).select(group, "threshold", "tn", "fp", "fn", "tp")
    rows = metrics_from_counts(_null_safe_join(at, best, [group, "threshold"]), class_names)
    return _null_safe_join(rows, _auc(_prefix_sums(held, [group]), [group]), [group]).select(
        group, "accuracy", "f1_macro", "precision", "recall", "roc_auc", "fpr", "fnr", "threshold", "dominant_error", "tn", "fp", "fn", "tp")


def evaluate_model(scored: DataFrame, model_name: str, label: str = "label", score: str = "score",
                   class_names: tuple[str, str] = ("negative", "positive")) -> DataFrame:
    """V11 for one model."""
    return evaluate_models(scored.withColumn("model", F.lit(model_name)), "model", label, score, class_names)


def round_metrics(m: DataFrame, decimals: int = 4) -> DataFrame:
    """Reference-style presentation: half-even rounding to 4 decimals."""
    cols = ("accuracy", "f1_macro", "precision", "recall", "roc_auc", "fpr", "fnr")
    return m.withColumns({c: F.bround(c, decimals) for c in cols if c in m.columns})


def rank_models(metrics: DataFrame) -> DataFrame:
    """Best model by F1-macro then ROC-AUC (both descending)."""
    return metrics.orderBy(F.desc("f1_macro"), F.desc("roc_auc"), "model").limit(1)


def add_verdicts(metrics: DataFrame, verdicts: dict) -> DataFrame:
    """Fixed verdict per model name, the winner's replaced by "Winner"."""
    best = rank_models(metrics).first()["model"]
    base = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in verdicts.items() for x in (F.lit(k), F.lit(v))]),
                                       F.col("model")), F.lit(""))
    return metrics.withColumn("verdict", F.when(F.col("model") == F.lit(best), F.lit("Winner")).otherwise(base))


def misclassification_table(metrics: DataFrame) -> DataFrame:
    """V14."""
    return metrics.select("model", "fpr", "fnr", "threshold", "dominant_error")


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count) at the model's own prediction column."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))


def comparison_long(metrics: DataFrame, cols: Sequence[str] = ("accuracy", "f1_macro", "precision", "recall",
                                                               "roc_auc", "fpr", "fnr", "threshold")) -> DataFrame:
    """Wide metrics -> long (model, metric, value)."""
    return metrics.select("model", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        "model", list(cols), "metric", "value")
