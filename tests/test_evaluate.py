import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import evaluate as ev

# (tn, fp, fn, tp) -> published Accuracy, F1-macro, Precision, Recall, FPR, FNR
GOLDEN = [
    ((228, 19, 24, 23), (0.8537, 0.7153, 0.7262, 0.7062, 0.0769, 0.5106)),
    ((231, 16, 26, 21), (0.8571, 0.7083, 0.7332, 0.6910, 0.0648, 0.5532)),
    ((226, 21, 22, 25), (0.8537, 0.7254, 0.7274, 0.7234, 0.0850, 0.4681)),
    ((218, 29, 20, 27), (0.8333, 0.7116, 0.6991, 0.7285, 0.1174, 0.4255)),
    ((226, 21, 23, 24), (0.8503, 0.7165, 0.7205, 0.7128, 0.0850, 0.4894)),
    ((200, 30, 15, 50), (0.8475, 0.7943, 0.7776, 0.8194, 0.1304, 0.2308)),
]


@pytest.mark.parametrize("counts,expect", GOLDEN)
def test_golden_confusion_metrics(spark, counts, expect):
    c = spark.createDataFrame([counts], "tn long, fp long, fn long, tp long")
    m = ev.round_metrics(ev.metrics_from_counts(c)).first()
    assert (m.accuracy, m.f1_macro, m.precision, m.recall, m.fpr, m.fnr) == expect
    assert m.dominant_error.startswith("Class 1")


def _scored(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.2).astype(int)
    s = np.round(np.clip(rng.normal(0.35 + 0.25 * y, 0.15), 0, 1), 2)  # ties on purpose
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double"), y, s


def _f1m(y, pred):
    out = []
    for c in (0, 1):
        tp = int(((pred == c) & (y == c)).sum())
        fp = int(((pred == c) & (y != c)).sum())
        fn = int(((pred != c) & (y == c)).sum())
        out.append(0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn))
    return sum(out) / 2


def test_sweep_equals_eighty_passes(spark):
    df, y, s = _scored(spark)
    sweep = {r.idx: r.f1_macro for r in ev.threshold_sweep(df).collect()}
    best_t, best_f = 0.5, 0.0
    for i, t in enumerate(ev.THRESHOLDS):
        f = _f1m(y, (s >= t).astype(int))
        assert sweep[i] == pytest.approx(f, abs=1e-15)
        if f > best_f:
            best_f, best_t = f, t
    assert ev.tuned_threshold(df) == round(best_t, 2)


def test_auc_equals_pair_counting(spark):
    df, y, s = _scored(spark)
    pos, neg = s[y == 1], s[y == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    auc = ev.roc_auc(df).first().roc_auc
    assert auc == pytest.approx(pairs / (len(pos) * len(neg)), abs=1e-12)


def test_roc_curve_ends(spark):
    df, y, s = _scored(spark)
    pts = ev.roc_curve(df).collect()
    assert max(p.fpr for p in pts) == 1.0 and max(p.tpr for p in pts) == 1.0
    assert any(p.threshold == float("inf") and p.fpr == 0 and p.tpr == 0 for p in pts)


def test_all_zero_f1_defaults_to_half(spark):
    df = spark.createDataFrame([(0, 0.95), (0, 0.97)], "label int, score double")
    assert ev.tuned_threshold(df) == 0.5


def test_single_class_is_na(spark):
    c = spark.createDataFrame([(10, 0, 0, 0)], "tn long, fp long, fn long, tp long")
    m = ev.metrics_from_counts(c).first()
    assert m.dominant_error == "N/A" and m.fpr == 0.0 and m.fnr == 0.0


def test_ranking_and_verdicts(spark):
    m = spark.createDataFrame([("a", 0.7153, 0.8011), ("b", 0.7083, 0.7983), ("c", 0.7254, 0.7934)],
                              "model string, f1_macro double, roc_auc double")
    assert ev.rank_models(m).first().model == "c"
    v = {r.model: r.verdict for r in ev.add_verdicts(m, {"a": "Baseline", "b": "Compare", "c": "Compare"}).collect()}
    assert v == {"a": "Baseline", "b": "Compare", "c": "Winner"}
    assert ev.comparison_long(m.withColumn("threshold", F.lit(0.5)), ("f1_macro", "roc_auc")).count() == 6


def test_models_in_one_plan_equal_each_alone(spark):
    """Hot scores, ties, a null group and a model with one class, over several partitions."""
    rng = np.random.default_rng(9)
    rows = [(m, int(y), float(np.round(np.clip(0.3 * y + rng.random() * 0.7, 0, 1), d))) for m, d in (("a", 2), ("b", 6), (None, 1)) for y in (rng.random(500) < 0.3)]
    rows += [("hot", i % 2, 0.5) for i in range(800)] + [("one", 1, 0.1 * (i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "model string, label int, score double").repartition(6)
    got = {r["model"]: r for r in ev.evaluate_models(df).collect()}
    assert set(got) == {"a", "b", None, "hot", "one"}
    for m, r in got.items():
        y = np.array([x[1] for x in rows if x[0] == m])
        s = np.array([x[2] for x in rows if x[0] == m])
        f1 = [_f1m(y, (s >= t).astype(int)) for t in ev.THRESHOLDS]
        assert r["threshold"] == (round(ev.THRESHOLDS[int(np.argmax(f1))], 2) if max(f1) > 0 else 0.5)
        assert (r["tp"], r["fp"]) == (int(((s >= r["threshold"]) & (y == 1)).sum()), int(((s >= r["threshold"]) & (y == 0)).sum()))
        pos, neg = s[y == 1], s[y == 0]
        if len(pos) and len(neg):
            auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
            assert abs(r["roc_auc"] - auc) < 1e-12
        else:
            assert r["roc_auc"] is None
    curve = ev.roc_curve(df, group=["model"]).collect()
    assert len(curve) == len({(x[0], x[2]) for x in rows}) + 5
