"""Registered queries: evaluation V1-V17 over three fixed-coefficient scorers of
documents ⋈ labels (scores rounded to 6 decimals so ties exist and both engines agree)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.exprs import sigmoid
from riskframe.operators import evaluate as ev
from riskframe.plans.catalog import DOC_SUBJECT_SQL, query, r6, with_views
from riskframe.plans.subjects import doc_subject

# name -> (c_len, shift, c_toxic, c_newlines, c_en): z = c_len*(ln(1+n_chars)-shift) + c_toxic*toxic
#                                                      - c_newlines*n_newlines + c_en*[lang = 'en']
SCORERS = {
    "scorer_a": (1.3, 7.0, 1.5, 0.01, 0.0),
    "scorer_b": (0.8, 7.5, 2.0, 0.0, 0.3),
    "scorer_c": (-0.6, 7.0, 1.0, 0.002, -0.2),
}
VERDICTS = {"scorer_a": "Baseline", "scorer_b": "Compare", "scorer_c": "Compare"}


def _z(params):
    a, s, t, nl, en = params
    x = F.log(F.lit(1.0) + F.col("n_chars").cast("double"))
    return (((F.lit(a) * (x - F.lit(s))) + (F.lit(t) * F.col("toxic").cast("double")))
            - (F.lit(nl) * F.col("n_newlines").cast("double"))) + (F.lit(en) * (F.col("lang") == "en").cast("double"))


def scored_docs(spark, sf_dir, models=tuple(SCORERS)):
    d = doc_subject(spark, sf_dir)
    rows = [F.struct(F.lit(m).alias("model"), F.round(sigmoid(_z(SCORERS[m])), 6).alias("score")) for m in models]
    return d.select("doc_id", "label", F.inline(F.array(*rows))).select("model", "doc_id", "label", "score")


def _z_sql(params):
    a, s, t, nl, en = params
    return (f"((({a}::DOUBLE * (ln(1.0::DOUBLE + CAST(n_chars AS DOUBLE)) - {s}::DOUBLE)) + ({t}::DOUBLE * CAST(toxic AS DOUBLE)))"
            f" - ({nl}::DOUBLE * CAST(n_newlines AS DOUBLE))) + ({en}::DOUBLE * CAST(lang = 'en' AS DOUBLE))")


SC_SQL = "sc AS (" + "\nUNION ALL ".join(
    f"SELECT '{m}' AS model, doc_id, label, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-({_z_sql(p)}))), 6) AS score FROM doc_subject"
    for m, p in SCORERS.items()) + ")"
TH_SQL = "th AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, CAST('{t!r}' AS DOUBLE), CAST('{r!r}' AS DOUBLE))"
    for i, (t, r) in enumerate(zip(ev.THRESHOLDS, ev.THRESHOLDS_ROUNDED))) + ") t(idx, t, tr))"


def _f1_sql(tp, fp, fn):
    return f"(CASE WHEN 2*{tp}+{fp}+{fn} = 0 THEN 0.0::DOUBLE ELSE CAST(2*{tp} AS DOUBLE) / CAST(2*{tp}+{fp}+{fn} AS DOUBLE) END)"


def _div_sql(a, b):
    return f"(CASE WHEN {b} = 0 THEN 0.0::DOUBLE ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


SWEEP_SQL = """
sw AS (SELECT model, idx, t, tr,
              count(*) FILTER (WHERE label = 1 AND score >= t) AS tp, count(*) FILTER (WHERE label = 0 AND score >= t) AS fp,
              count(*) FILTER (WHERE label = 1 AND score < t) AS fn, count(*) FILTER (WHERE label = 0 AND score < t) AS tn
       FROM sc, th GROUP BY model, idx, t, tr)""" + f""",
swf AS (SELECT *, ({_f1_sql('tp', 'fp', 'fn')} + {_f1_sql('tn', 'fn', 'fp')}) / 2.0::DOUBLE AS f1_macro FROM sw),
best AS (SELECT model, CASE WHEN f1_macro > 0 THEN tr ELSE 0.5::DOUBLE END AS threshold, f1_macro
         FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1_macro DESC, idx) AS rn FROM swf) x WHERE rn = 1),
cm AS (SELECT s.model, b.threshold,
              count(*) FILTER (WHERE label = 0 AND score < b.threshold) AS tn, count(*) FILTER (WHERE label = 0 AND score >= b.threshold) AS fp,
              count(*) FILTER (WHERE label = 1 AND score < b.threshold) AS fn, count(*) FILTER (WHERE label = 1 AND score >= b.threshold) AS tp
       FROM sc s JOIN best b ON s.model = b.model GROUP BY s.model, b.threshold),
auc AS (SELECT p.model, (CAST(count(*) FILTER (WHERE p.score > n.score) AS DOUBLE)
                         + 0.5::DOUBLE * CAST(count(*) FILTER (WHERE p.score = n.score) AS DOUBLE)) / CAST(count(*) AS DOUBLE) AS roc_auc
        FROM sc p JOIN sc n ON p.model = n.model AND p.label = 1 AND n.label = 0 GROUP BY p.model),
mt AS (SELECT cm.model, {_div_sql('tn + tp', 'tn + fp + fn + tp')} AS accuracy,
              ({_f1_sql('tp', 'fp', 'fn')} + {_f1_sql('tn', 'fn', 'fp')}) / 2.0::DOUBLE AS f1_macro,
              ({_div_sql('tn', 'tn + fn')} + {_div_sql('tp', 'tp + fp')}) / 2.0::DOUBLE AS precision,
              ({_div_sql('tn', 'tn + fp')} + {_div_sql('tp', 'tp + fn')}) / 2.0::DOUBLE AS recall,
              auc.roc_auc,
              CASE WHEN (tn + fp + fn) > 0 AND (tp + fn + fp) > 0 THEN {_div_sql('fp', 'fp + tn')} ELSE 0.0::DOUBLE END AS fpr,
              CASE WHEN (tn + fp + fn) > 0 AND (tp + fn + fp) > 0 THEN {_div_sql('fn', 'fn + tp')} ELSE 0.0::DOUBLE END AS fnr,
              cm.threshold, tn, fp, fn, tp
       FROM cm JOIN auc ON cm.model = auc.model),
mtd AS (SELECT *, CASE WHEN NOT ((tn + fp + fn) > 0 AND (tp + fn + fp) > 0) THEN 'N/A'
                       WHEN fpr > fnr THEN 'Class 0 (negative predicted as positive)'
                       ELSE 'Class 1 (positive predicted as negative)' END AS dominant_error FROM mt)"""

EVAL_VIEWS = with_views(DOC_SUBJECT_SQL, SC_SQL, TH_SQL, SWEEP_SQL)


def metrics_table(spark, sf_dir):
    return ev.evaluate_models(scored_docs(spark, sf_dir))


_M6 = ("accuracy", "f1_macro", "precision", "recall", "roc_auc", "fpr", "fnr")


@query("v1_threshold_sweep", EVAL_VIEWS + """
SELECT model, idx, t AS threshold, tn, fp, fn, tp, round(f1_macro, 6) AS f1_macro FROM swf""")
def v1_threshold_sweep(spark, sf_dir):
    return ev.threshold_sweep(scored_docs(spark, sf_dir), group=["model"]).withColumn("f1_macro", r6("f1_macro")).withColumn("idx", F.col("idx").cast("int"))


@query("v1_best_threshold", EVAL_VIEWS + """
SELECT model, threshold, round(f1_macro, 6) AS f1_macro FROM best""")
def v1_best_threshold(spark, sf_dir):
    sweep = ev.threshold_sweep(scored_docs(spark, sf_dir), group=["model"])
    return ev.best_threshold(sweep, group=["model"]).withColumn("f1_macro", r6("f1_macro"))


@query("v2_confusion_counts", EVAL_VIEWS + """
SELECT model, threshold, tn, fp, fn, tp FROM cm""")
def v2_confusion_counts(spark, sf_dir):
    return metrics_table(spark, sf_dir).select("model", "threshold", "tn", "fp", "fn", "tp")


@query("v7_roc_auc", EVAL_VIEWS + """
SELECT model, round(roc_auc, 6) AS roc_auc FROM auc""")
def v7_roc_auc(spark, sf_dir):
    return ev.roc_auc(scored_docs(spark, sf_dir), group=["model"]).withColumn("roc_auc", r6("roc_auc"))


@query("v10_class_report", EVAL_VIEWS + f""",
c AS (SELECT * FROM cm WHERE model = 'scorer_a')
SELECT '0' AS class, round({_div_sql('tn', 'tn + fn')}, 6) AS precision, round({_div_sql('tn', 'tn + fp')}, 6) AS recall,
       round({_f1_sql('tn', 'fn', 'fp')}, 6) AS f1_score, CAST(tn + fp AS BIGINT) AS support FROM c
UNION ALL
SELECT '1', round({_div_sql('tp', 'tp + fp')}, 6), round({_div_sql('tp', 'tp + fn')}, 6), round({_f1_sql('tp', 'fp', 'fn')}, 6),
       CAST(tp + fn AS BIGINT) FROM c
UNION ALL
SELECT 'macro avg', round(({_div_sql('tn', 'tn + fn')} + {_div_sql('tp', 'tp + fp')}) / 2, 6),
       round(({_div_sql('tn', 'tn + fp')} + {_div_sql('tp', 'tp + fn')}) / 2, 6),
       round(({_f1_sql('tn', 'fn', 'fp')} + {_f1_sql('tp', 'fp', 'fn')}) / 2, 6), CAST(tn + fp + fn + tp AS BIGINT) FROM c
UNION ALL
SELECT 'weighted avg',
       round({_div_sql(f"{_div_sql('tn', 'tn + fn')} * (tn + fp) + {_div_sql('tp', 'tp + fp')} * (tp + fn)", 'tn + fp + fn + tp')}, 6),
       round({_div_sql(f"{_div_sql('tn', 'tn + fp')} * (tn + fp) + {_div_sql('tp', 'tp + fn')} * (tp + fn)", 'tn + fp + fn + tp')}, 6),
       round({_div_sql(f"{_f1_sql('tn', 'fn', 'fp')} * (tn + fp) + {_f1_sql('tp', 'fp', 'fn')} * (tp + fn)", 'tn + fp + fn + tp')}, 6),
       CAST(tn + fp + fn + tp AS BIGINT) FROM c""")
def v10_class_report(spark, sf_dir):
    sc = scored_docs(spark, sf_dir, ("scorer_a",))
    c = ev.confusion_counts(sc, ev.tuned_threshold(sc))
    rep = ev.class_report(c)
    return rep.withColumns({x: r6(x) for x in ("precision", "recall", "f1_score")})


@query("v11_metrics_table", EVAL_VIEWS + """
SELECT model, """ + ", ".join(f"round({c}, 6) AS {c}" for c in _M6) + """, threshold, dominant_error FROM mtd""")
def v11_metrics_table(spark, sf_dir):
    m = metrics_table(spark, sf_dir)
    return m.select("model", *[r6(c).alias(c) for c in _M6], "threshold", "dominant_error")


@query("v12_best_model", EVAL_VIEWS + """
SELECT model, round(f1_macro, 6) AS f1_macro, round(roc_auc, 6) AS roc_auc FROM mtd
ORDER BY f1_macro DESC, roc_auc DESC, model LIMIT 1""")
def v12_best_model(spark, sf_dir):
    return ev.rank_models(metrics_table(spark, sf_dir)).select("model", r6("f1_macro").alias("f1_macro"),
                                                               r6("roc_auc").alias("roc_auc"))


@query("v13_verdicts", EVAL_VIEWS + """,
w AS (SELECT model FROM mtd ORDER BY f1_macro DESC, roc_auc DESC, model LIMIT 1)
SELECT model, CASE WHEN model = (SELECT model FROM w) THEN 'Winner'
                   ELSE CASE model """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in VERDICTS.items()) + """ ELSE '' END END
       AS verdict
FROM mtd""")
def v13_verdicts(spark, sf_dir):
    return ev.add_verdicts(metrics_table(spark, sf_dir), VERDICTS).select("model", "verdict")


@query("v14_misclassification", EVAL_VIEWS + """
SELECT model, round(fpr, 6) AS fpr, round(fnr, 6) AS fnr, threshold, dominant_error FROM mtd""")
def v14_misclassification(spark, sf_dir):
    t = ev.misclassification_table(metrics_table(spark, sf_dir))
    return t.withColumns({"fpr": r6("fpr"), "fnr": r6("fnr")})


@query("v15_roc_curve", EVAL_VIEWS + """,
a AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM sc GROUP BY model, score),
c AS (SELECT model, score, sum(pos) OVER up AS tp, sum(neg) OVER up AS fp, sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
      FROM a WINDOW up AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT model, score AS threshold, round(CAST(fp AS DOUBLE) / N, 6) AS fpr, round(CAST(tp AS DOUBLE) / P, 6) AS tpr FROM c
UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 0.0, 0.0 FROM sc""")
def v15_roc_curve(spark, sf_dir):
    c = ev.roc_curve(scored_docs(spark, sf_dir), group=["model"])
    return c.withColumns({"fpr": r6("fpr"), "tpr": r6("tpr")})


@query("v16_confusion_matrix", with_views(DOC_SUBJECT_SQL, SC_SQL) + """
SELECT label, CAST(score >= 0.5 AS INTEGER) AS prediction, count(*) AS count FROM sc WHERE model = 'scorer_a'
GROUP BY label, prediction""")
def v16_confusion_matrix(spark, sf_dir):
    sc = scored_docs(spark, sf_dir, ("scorer_a",)).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return ev.confusion_matrix(sc)


_LONG = _M6 + ("threshold",)


@query("v17_comparison_long", EVAL_VIEWS + "\n" + "\nUNION ALL ".join(
    f"SELECT model, '{c}' AS metric, round(CAST({c} AS DOUBLE), 6) AS value FROM mtd" for c in _LONG))
def v17_comparison_long(spark, sf_dir):
    return ev.comparison_long(metrics_table(spark, sf_dir), _LONG).withColumn("value", r6("value"))
