"""Registered queries: explanations X2, X4, X8, X9 and scoring P1, P3-P6 with a
fixed-coefficient linear scorer over encoded documents ⋈ labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import encode, explain, score
from riskframe.plans.catalog import DOC_SUBJECT_SQL, ORDER_SUBJECT_SQL, query, r6, with_views
from riskframe.spec import Roles
from riskframe.plans.subjects import doc_subject, md5_mask, order_subject

DOC_WEIGHTS = {"scaler__n_chars": 0.8, "scaler__n_spaces": -0.3, "scaler__n_newlines": 0.2,
               "onehot__lang_en": -0.5, "onehot__lang_es": 0.1, "onehot__lang_fr": 0.25}
DOC_INTERCEPT = -1.7
DOC_INPUT = ("doc_id", "lang", "source", "n_chars", "n_spaces", "n_newlines", "toxic", "label")


def _encoder(fit_df):
    return encode.fit_encoder(fit_df, {}, ["lang"], ["n_chars", "n_spaces", "n_newlines"])


def doc_encoded(spark, sf_dir):
    d = doc_subject(spark, sf_dir)
    return _encoder(d).transform(d, keep=list(DOC_INPUT))


ENC_SQL = """
st AS (SELECT avg(n_chars) AS m1, stddev_pop(n_chars) AS s1, avg(n_spaces) AS m2, stddev_pop(n_spaces) AS s2,
              avg(n_newlines) AS m3, stddev_pop(n_newlines) AS s3 FROM doc_subject),
enc AS (SELECT d.*, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS onehot__lang_en,
               CASE WHEN lang = 'es' THEN 1.0 ELSE 0.0 END AS onehot__lang_es,
               CASE WHEN lang = 'fr' THEN 1.0 ELSE 0.0 END AS onehot__lang_fr,
               (CAST(n_chars AS DOUBLE) - m1) / s1 AS scaler__n_chars, (CAST(n_spaces AS DOUBLE) - m2) / s2 AS scaler__n_spaces,
               (CAST(n_newlines AS DOUBLE) - m3) / s3 AS scaler__n_newlines
        FROM doc_subject d, st),
bg AS (SELECT """ + ", ".join(f"avg({f}) AS bg_{f}" for f in DOC_WEIGHTS) + """ FROM enc),
phi AS (""" + "\n UNION ALL ".join(
    f"SELECT doc_id, '{f}' AS feature, {w}::DOUBLE * ({f} - bg_{f}) AS phi FROM enc, bg" for f, w in DOC_WEIGHTS.items()) + """),
prob AS (SELECT enc.*, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(""" + f"{DOC_INTERCEPT}::DOUBLE" + "".join(
    f" + {w}::DOUBLE * {f}" for f, w in DOC_WEIGHTS.items()) + """))) AS p FROM enc)"""

EXPLAIN_VIEWS = with_views(DOC_SUBJECT_SQL, ENC_SQL)


def doc_phi(spark, sf_dir):
    enc = doc_encoded(spark, sf_dir)
    means = explain.background_means(enc, list(DOC_WEIGHTS))
    return explain.linear_contributions(enc, "doc_id", DOC_WEIGHTS, means)


@query("x2_linear_shap", EXPLAIN_VIEWS + """
SELECT doc_id, feature, round(phi, 6) AS phi FROM phi""")
def x2_linear_shap(spark, sf_dir):
    return doc_phi(spark, sf_dir).withColumn("phi", r6("phi"))


@query("x4_shap_summary", EXPLAIN_VIEWS + """
SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi FROM phi GROUP BY feature
ORDER BY avg(abs(phi)) DESC, feature LIMIT 10""")
def x4_shap_summary(spark, sf_dir):
    return explain.shap_summary(doc_phi(spark, sf_dir), 10).withColumn("mean_abs_phi", r6("mean_abs_phi"))


@query("x8_top_contributions", EXPLAIN_VIEWS + """
SELECT doc_id, feature, round(phi, 6) AS phi, CAST(rank AS INTEGER) AS rank,
       CASE WHEN phi > 0 THEN 'increases' ELSE 'decreases' END AS direction
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(phi) DESC, feature) AS rank FROM phi) t
WHERE rank <= 5""")
def x8_top_contributions(spark, sf_dir):
    enc = doc_encoded(spark, sf_dir)
    means = explain.background_means(enc, list(DOC_WEIGHTS))
    t = enc.select("doc_id", F.inline(explain.top_linear(enc, DOC_WEIGHTS, means)))
    return t.select("doc_id", "feature", r6("phi").alias("phi"), "rank", "direction")


def doc_scored(spark, sf_dir):
    raw = doc_subject(spark, sf_dir).select(*DOC_INPUT)
    enc = _encoder(raw)
    p = score.linear_probability(DOC_WEIGHTS, DOC_INTERCEPT)
    return score.score_table(raw, Roles(target="label", key="doc_id"),
                             lambda d: enc.transform(d, keep=["_raw"]).withColumn("_p", p), enc.input_columns())


@query("p1_batch_score", EXPLAIN_VIEWS + """
SELECT """ + ", ".join(DOC_INPUT) + """, CASE WHEN p >= 0.5 THEN 'Yes' ELSE 'No' END AS Prediction,
       round_even(p, 4) AS Probability FROM prob""")
def p1_batch_score(spark, sf_dir):
    return doc_scored(spark, sf_dir)


@query("p5_preview", EXPLAIN_VIEWS + """
SELECT doc_id, CASE WHEN p >= 0.5 THEN 'Yes' ELSE 'No' END AS Prediction, round_even(p, 4) AS Probability
FROM prob ORDER BY doc_id LIMIT 10""")
def p5_preview(spark, sf_dir):
    return score.preview(doc_scored(spark, sf_dir), "doc_id", 10)


# ------------------------------------------------------------ defaults / P3-P4
RAW_ORDERS_SQL = """
raw AS (SELECT o.o_orderkey, o.o_totalprice, c.c_acctbal, c.c_mktsegment, CAST(c.c_nationkey AS INTEGER) AS c_nationkey
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
dft AS (SELECT quantile_cont(c_acctbal, 0.5) AS d_acct,
               (SELECT c_mktsegment FROM raw GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1) AS d_seg,
               CAST(trunc(quantile_cont(c_nationkey, 0.5)) AS INTEGER) AS d_nat FROM raw)"""


def order_defaults(spark, sf_dir):
    raw = order_subject(spark, sf_dir, masked=False)
    return score.compute_defaults(raw, ["c_acctbal"], ["c_mktsegment"], ["c_nationkey"])


@query("p3_defaults_profile", with_views(RAW_ORDERS_SQL) + """
SELECT round(d_acct, 6) AS c_acctbal, d_seg AS c_mktsegment, d_nat AS c_nationkey FROM dft""")
def p3_defaults_profile(spark, sf_dir):
    d = order_defaults(spark, sf_dir)
    row = spark.createDataFrame([(d["c_acctbal"], d["c_mktsegment"], d["c_nationkey"])],
                                "c_acctbal double, c_mktsegment string, c_nationkey int")
    # the profile is computed from the table; here it is returned as the one-row result
    return row.withColumn("c_acctbal", r6("c_acctbal"))


@query("p4_complete_records", with_views(ORDER_SUBJECT_SQL, RAW_ORDERS_SQL) + """
SELECT o_orderkey, round(COALESCE(c_acctbal, d_acct), 6) AS c_acctbal, COALESCE(c_mktsegment, d_seg) AS c_mktsegment,
       d_nat AS c_nationkey
FROM order_subject, dft""")
def p4_complete_records(spark, sf_dir):
    partial = order_subject(spark, sf_dir).select("o_orderkey", "c_acctbal", "c_mktsegment")  # c_nationkey absent
    full = score.complete_records(partial, order_defaults(spark, sf_dir), {"c_nationkey": "int"})
    return full.select("o_orderkey", r6("c_acctbal").alias("c_acctbal"), "c_mktsegment", "c_nationkey")


# ------------------------------------------------------------ P6 ---------------
P6_SQL = with_views(DOC_SUBJECT_SQL, """
dflt AS (SELECT quantile_cont(n_newlines, 0.5) AS d_nl,
                (SELECT lang FROM doc_subject GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS d_lang FROM doc_subject)""", """
part AS (SELECT doc_id, n_chars, n_spaces,
                CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) = '3' THEN NULL ELSE CAST(n_newlines AS DOUBLE) END AS n_newlines,
                CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) = '4' THEN NULL ELSE lang END AS lang FROM doc_subject)""", """
comp AS (SELECT doc_id, n_chars, n_spaces, COALESCE(n_newlines, d_nl) AS n_newlines, COALESCE(lang, d_lang) AS lang
         FROM part, dflt)""", ENC_SQL.replace("FROM doc_subject d, st", "FROM comp d, st")
                .replace("FROM doc_subject),", "FROM doc_subject),", 1)) + """
SELECT p.doc_id, CASE WHEN p.p >= 0.5 THEN 'Yes' ELSE 'No' END AS Prediction, round_even(p.p, 4) AS Probability,
       t.feature, round(t.phi, 6) AS phi, CAST(t.rank AS INTEGER) AS rank,
       CASE WHEN t.phi > 0 THEN 'increases' ELSE 'decreases' END AS direction
FROM prob p JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(phi) DESC, feature) AS rank FROM phi) t
  ON p.doc_id = t.doc_id
WHERE t.rank <= 5"""


@query("p6_score_and_explain", P6_SQL)
def p6_score_and_explain(spark, sf_dir):
    raw = doc_subject(spark, sf_dir)
    enc_model = _encoder(raw)  # fitted on the full raw table
    defaults = score.compute_defaults(raw, ["n_newlines"], ["lang"], [])
    partial = raw.select(
        "doc_id", "n_chars", "n_spaces",
        F.when(md5_mask("doc_id", "3"), F.lit(None).cast("double")).otherwise(F.col("n_newlines").cast("double"))
        .alias("n_newlines"),
        F.when(md5_mask("doc_id", "4"), F.lit(None).cast("string")).otherwise(F.col("lang")).alias("lang"))
    full = score.complete_records(partial, defaults)
    enc = enc_model.transform(full, keep=["doc_id"])
    means = explain.background_means(enc, list(DOC_WEIGHTS))
    scored = score.label_and_probability(enc, score.linear_probability(DOC_WEIGHTS, DOC_INTERCEPT))
    top = F.inline(explain.top_linear(scored, DOC_WEIGHTS, means))
    return scored.select("doc_id", "Prediction", "Probability", top) \
        .select("doc_id", "Prediction", "Probability", "feature", r6("phi").alias("phi"), "rank", "direction")
