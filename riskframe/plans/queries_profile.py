"""Registered queries: profiling / EDA A1-A17."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import clean, profile
from riskframe.plans.catalog import (DOC_SUBJECT_SQL, LINE_SUBJECT_SQL, ORDER_SUBJECT_SQL, query, r6, with_views)
from riskframe.plans.subjects import DOC_NUMERIC, doc_subject, line_subject, order_subject
from riskframe.sources.tables import read_table


@query("a1_shape", """
SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_cols, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns
FROM customer""")
def a1_shape(spark, sf_dir):
    return profile.shape(read_table(spark, sf_dir, "customer"))


@query("a2_head", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5""")
def a2_head(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                   "o_orderpriority")
    return profile.head(o, "o_orderkey", 5)


@query("a3_info", """
WITH c AS (SELECT count(c_custkey) AS a, count(c_name) AS b, count(c_nationkey) AS c, count(c_acctbal) AS d,
                  count(c_mktsegment) AS e FROM customer)
SELECT 'c_custkey' AS column, 'bigint' AS dtype, a AS non_null FROM c
UNION ALL SELECT 'c_name', 'string', b FROM c
UNION ALL SELECT 'c_nationkey', 'int', c FROM c
UNION ALL SELECT 'c_acctbal', 'double', d FROM c
UNION ALL SELECT 'c_mktsegment', 'string', e FROM c""")
def a3_info(spark, sf_dir):
    return profile.info(read_table(spark, sf_dir, "customer"))


DESCRIBE_SQL = """
SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max
FROM order_subject"""


@query("a4_describe", with_views(ORDER_SUBJECT_SQL) + "\nUNION ALL".join(
    DESCRIBE_SQL.format(c=c) for c in ("o_totalprice", "c_acctbal")))
def a4_describe(spark, sf_dir):
    d = profile.describe(order_subject(spark, sf_dir), ["o_totalprice", "c_acctbal"])
    return d.select("column", "count", *[r6(c).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@query("a5_null_counts", with_views(ORDER_SUBJECT_SQL) + """
SELECT "column", n_null FROM (
  SELECT 'c_acctbal' AS column, count(*) FILTER (WHERE c_acctbal IS NULL) AS n_null FROM order_subject
  UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL) FROM order_subject
  UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM order_subject) t
WHERE n_null > 0""")
def a5_null_counts(spark, sf_dir):
    return profile.null_counts(order_subject(spark, sf_dir).select("o_totalprice", "c_acctbal", "c_mktsegment"))


@query("a6_duplicate_count", """
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey, l_quantity FROM lineitem)) AS BIGINT)
       AS n_duplicates FROM lineitem""")
def a6_duplicate_count(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return profile.duplicate_count(li, ["l_partkey", "l_suppkey", "l_quantity"])


@query("a7_value_counts", """
SELECT o_orderpriority AS value, count(*) AS count FROM orders GROUP BY o_orderpriority""")
def a7_value_counts(spark, sf_dir):
    return profile.value_counts(read_table(spark, sf_dir, "orders"), "o_orderpriority")


@query("a8_value_shares", """
SELECT c_mktsegment AS value, count(*) AS count,
       round(count(*) * 100.0 / (SELECT count(*) FROM customer), 2) AS percent
FROM customer GROUP BY c_mktsegment""")
def a8_value_shares(spark, sf_dir):
    return profile.value_shares(read_table(spark, sf_dir, "customer"), "c_mktsegment")


HIST_SQL = """
SELECT "column", label, bin, round(mn + (bin - 1) * ((mx - mn) / 20.0), 6) AS lo,
       round(mn + bin * ((mx - mn) / 20.0), 6) AS hi, count(*) AS count
FROM (
  SELECT '{c}' AS column, s.label, g.mn, g.mx,
         CASE WHEN g.mx - g.mn = 0 THEN CAST(1 AS BIGINT)
              ELSE least(CAST(floor((CAST(s.{c} AS DOUBLE) - g.mn) * 20.0 / (g.mx - g.mn)) AS BIGINT) + 1, 20) END AS bin
  FROM doc_subject s JOIN (SELECT label, CAST(min({c}) AS DOUBLE) AS mn, CAST(max({c}) AS DOUBLE) AS mx
                           FROM doc_subject GROUP BY label) g ON s.label = g.label) t
GROUP BY "column", label, bin, mn, mx"""


@query("a9_histogram", with_views(DOC_SUBJECT_SQL) + "\nUNION ALL".join(HIST_SQL.format(c=c) for c in ("n_chars", "n_spaces")))
def a9_histogram(spark, sf_dir):
    h = profile.histogram(doc_subject(spark, sf_dir), ["n_chars", "n_spaces"], "label", bins=20)
    return h.withColumns({"lo": r6("lo"), "hi": r6("hi")})


RATE_SQL = """
SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS level, count(*) AS n, round(avg(CAST(label AS DOUBLE)) * 100.0, 6) AS rate_pct
FROM doc_subject GROUP BY {c}"""


@query("a10_positive_rate", with_views(DOC_SUBJECT_SQL) + "\nUNION ALL".join(
    RATE_SQL.format(c=c) for c in ("lang", "source", "toxic")))
def a10_positive_rate(spark, sf_dir):
    r = profile.positive_rate(doc_subject(spark, sf_dir), ["lang", "source", "toxic"], "label")
    return r.withColumn("rate_pct", r6("rate_pct"))


BOX_SQL = """
SELECT '{c}' AS column, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lo, 6) AS lower, round(hi, 6) AS upper,
       round(min(CASE WHEN v BETWEEN lo AND hi THEN v END), 6) AS whisker_lo,
       round(max(CASE WHEN v BETWEEN lo AND hi THEN v END), 6) AS whisker_hi,
       count(*) FILTER (WHERE NOT (v BETWEEN lo AND hi)) AS n_outliers
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM doc_subject) s,
     (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM doc_subject)) f
GROUP BY q1, q3, lo, hi"""


@query("a11_box_stats", with_views(DOC_SUBJECT_SQL) + "\nUNION ALL".join(BOX_SQL.format(c=c) for c in DOC_NUMERIC))
def a11_box_stats(spark, sf_dir):
    b = profile.box_stats(doc_subject(spark, sf_dir), list(DOC_NUMERIC))
    return b.select("column", *[r6(c).alias(c) for c in ("q1", "q3", "lower", "upper", "whisker_lo", "whisker_hi")],
                    "n_outliers")


@query("a12_clip_report", """
WITH f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
           FROM (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents)),
c AS (SELECT CAST(n_chars AS DOUBLE) AS v, least(greatest(CAST(n_chars AS DOUBLE), lo), hi) AS w, lo, hi FROM documents, f)
SELECT 'n_chars' AS column, count(*) FILTER (WHERE v < lo OR v > hi) AS outliers_before, round(max(v), 6) AS max_before,
       count(*) FILTER (WHERE w < lo OR w > hi) AS outliers_after, round(max(w), 6) AS max_after FROM c""")
def a12_clip_report(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("n_chars")
    r = profile.clip_report(d, clean.fit_fences(d, ["n_chars"]))
    return r.withColumns({"max_before": r6("max_before"), "max_after": r6("max_after")})


LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice", "c_acctbal", "p_size",
                "p_retailprice", "label")


def _corr_sql(a: str, b: str) -> str:
    return (f"round(covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0), 6)")


@query("a14_correlation_matrix", with_views(LINE_SUBJECT_SQL) + "\nUNION ALL".join(
    f"\nSELECT '{a}' AS col_a, '{b}' AS col_b, {_corr_sql(a, b)} AS corr FROM line_subject"
    for a in LINE_NUMERIC for b in LINE_NUMERIC))
def a14_correlation_matrix(spark, sf_dir):
    ls = line_subject(spark, sf_dir)
    cols = profile.numeric_columns(ls.select(*LINE_NUMERIC))  # A13: selection by dtype
    return profile.correlation_matrix(ls, cols).withColumn("corr", r6("corr"))


@query("a15_target_correlations", with_views(LINE_SUBJECT_SQL) + """
SELECT feature, corr FROM (""" + "\nUNION ALL".join(
    f"\nSELECT '{a}' AS feature, {_corr_sql(a, 'label')} AS corr FROM line_subject" for a in LINE_NUMERIC[:-1]) + """
) t WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 10""")
def a15_target_correlations(spark, sf_dir):
    t = profile.target_correlations(line_subject(spark, sf_dir), list(LINE_NUMERIC[:-1]), "label", 10)
    return t.withColumn("corr", r6("corr"))


@query("a16_group_means", with_views(DOC_SUBJECT_SQL) + """
SELECT label, """ + ", ".join(f"round(avg(CAST({c} AS DOUBLE)), 6) AS mean_{c}" for c in DOC_NUMERIC) + """
FROM doc_subject GROUP BY label
UNION ALL
SELECT toxic + 10, """ + ", ".join(f"round(avg(CAST({c} AS DOUBLE)), 6)" for c in DOC_NUMERIC) + """
FROM doc_subject GROUP BY toxic""")
def a16_group_means(spark, sf_dir):
    d = doc_subject(spark, sf_dir)
    by_label = profile.group_means(d, DOC_NUMERIC, "label")
    # the same operator by a flag column (offset 10 keeps the two groupings apart)
    by_flag = profile.group_means(d, DOC_NUMERIC, "toxic").withColumn("toxic", F.col("toxic") + 10) \
        .withColumnRenamed("toxic", "label")
    out = by_label.unionByName(by_flag)
    return out.select("label", *[r6(f"mean_{c}").alias(f"mean_{c}") for c in DOC_NUMERIC])


@query("a17_class_distribution", with_views(DOC_SUBJECT_SQL) + """
SELECT label AS class, count(*) AS count FROM doc_subject GROUP BY label""")
def a17_class_distribution(spark, sf_dir):
    return profile.class_distribution(doc_subject(spark, sf_dir), "label")
