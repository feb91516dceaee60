"""Registered queries: sources S1, cleaning C1-C12."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import clean
from riskframe.plans.catalog import (DOC_SUBJECT_SQL, ORDER_SUBJECT_SQL, query, r6, with_views)
from riskframe.plans.subjects import ORDER_ROLES, order_subject
from riskframe.sources.tables import read_table


@query("s1_scan_customer", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def s1_scan_customer(spark, sf_dir):
    return read_table(spark, sf_dir, "customer")


@query("c1_drop_columns", """
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def c1_drop_columns(spark, sf_dir):
    # c_comment is absent: dropping it is a no-op, like the original "if present"
    return clean.drop_columns(read_table(spark, sf_dir, "customer"), ["c_name", "c_comment"])


@query("c2_target_map", """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS o_orderstatus
FROM orders""")
def c2_target_map(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return clean.map_target(o, "o_orderstatus", {"F": 1, "O": 0})


@query("c3_cast_string", """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part""")
def c3_cast_string(spark, sf_dir):
    return clean.cast_to_string(read_table(spark, sf_dir, "part").select("p_partkey", "p_size"), ["p_size"])


# size band code -> label; codes 0 and 5 are deliberately unmapped (-> null)
SIZE_BAND_LABELS = {1: "Small", 2: "Medium", 3: "Large", 4: "Huge"}


@query("c4_code_labels", """
SELECT p_partkey, CASE p_size // 10 WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' WHEN 3 THEN 'Large'
                  WHEN 4 THEN 'Huge' END AS size_band
FROM part""")
def c4_code_labels(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    coded = p.select("p_partkey", (F.col("p_size") / 10).cast("int").alias("size_band"))
    return clean.code_to_label(coded, {"size_band": SIZE_BAND_LABELS})


@query("c5_validate", with_views(ORDER_SUBJECT_SQL) + """
SELECT 'non_empty' AS check_name, count(*) > 0 AS passed, '' AS detail FROM order_subject
UNION ALL SELECT 'target_present', true, 'o_orderstatus'
UNION ALL SELECT 'required_present', true, ''""")
def c5_validate(spark, sf_dir):
    rep = clean.validation_report(order_subject(spark, sf_dir), ORDER_ROLES)
    return rep.withColumnRenamed("check", "check_name")


@query("c6_dedup_lineitem", """
SELECT l_partkey, l_suppkey, l_quantity, min(l_orderkey * 8 + l_linenumber) AS line_key
FROM lineitem GROUP BY l_partkey, l_suppkey, l_quantity""")
def c6_dedup_lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    d = li.select("l_partkey", "l_suppkey", "l_quantity",
                  (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_key"))
    return clean.remove_duplicates(d, key="line_key")


@query("c7_median_impute", with_views(ORDER_SUBJECT_SQL, """
m AS (SELECT quantile_cont(c_acctbal, 0.5) AS med FROM order_subject)""") + """
SELECT o_orderkey, round(COALESCE(c_acctbal, (SELECT med FROM m)), 6) AS c_acctbal FROM order_subject""")
def c7_median_impute(spark, sf_dir):
    s = order_subject(spark, sf_dir).select("o_orderkey", "c_acctbal")
    prof = clean.fit_impute(s, ["c_acctbal"], [])
    return clean.apply_impute(s, prof).withColumn("c_acctbal", r6("c_acctbal"))


@query("c8_mode_impute", with_views(ORDER_SUBJECT_SQL, """
m AS (SELECT c_mktsegment AS v FROM order_subject WHERE c_mktsegment IS NOT NULL
      GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)""") + """
SELECT o_orderkey, COALESCE(c_mktsegment, (SELECT v FROM m)) AS c_mktsegment FROM order_subject""")
def c8_mode_impute(spark, sf_dir):
    s = order_subject(spark, sf_dir).select("o_orderkey", "c_mktsegment")
    prof = clean.fit_impute(s, [], ["c_mktsegment"])
    return clean.apply_impute(s, prof)


FENCE_SQL = """
SELECT '{col}' AS column, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper
FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {table})"""


@query("c9_iqr_fences", "\nUNION ALL\n".join([
    FENCE_SQL.format(col="n_chars", table="documents"),
    FENCE_SQL.format(col="value", table="events"),
    FENCE_SQL.format(col="o_totalprice", table="orders"),
]))
def c9_iqr_fences(spark, sf_dir):
    parts = [
        clean.iqr_fences(read_table(spark, sf_dir, "documents"), ["n_chars"]),
        clean.iqr_fences(read_table(spark, sf_dir, "events"), ["value"]),
        clean.iqr_fences(read_table(spark, sf_dir, "orders"), ["o_totalprice"]),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("column", *[r6(c).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")])


@query("c10_clip_outliers", """
WITH f AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM documents)
SELECT doc_id, round(least(greatest(CAST(n_chars AS DOUBLE), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 6) AS n_chars
FROM documents, f""")
def c10_clip_outliers(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    fences = clean.fit_fences(d, ["n_chars"])
    return clean.clip_outliers(d, fences).withColumn("n_chars", r6("n_chars"))


@query("c11_preprocess", with_views(ORDER_SUBJECT_SQL, """
cleaned AS (
  SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS o_orderstatus,
         o_totalprice, o_orderpriority, c_acctbal, c_mktsegment FROM order_subject)""", """
med AS (SELECT quantile_cont(o_totalprice, 0.5) AS m_tp, quantile_cont(c_acctbal, 0.5) AS m_ab FROM cleaned)""", """
md AS (SELECT c_mktsegment AS v FROM cleaned WHERE c_mktsegment IS NOT NULL
       GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)""", """
imputed AS (
  SELECT o_orderkey, o_orderstatus, COALESCE(o_totalprice, (SELECT m_tp FROM med)) AS o_totalprice, o_orderpriority,
         COALESCE(c_acctbal, (SELECT m_ab FROM med)) AS c_acctbal, COALESCE(c_mktsegment, (SELECT v FROM md)) AS c_mktsegment
  FROM cleaned)""", """
dedup AS (
  SELECT min(o_orderkey) AS o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, c_acctbal, c_mktsegment
  FROM imputed GROUP BY o_orderstatus, o_totalprice, o_orderpriority, c_acctbal, c_mktsegment)""", """
f AS (SELECT quantile_cont(o_totalprice, 0.25) AS a1, quantile_cont(o_totalprice, 0.75) AS a3,
             quantile_cont(c_acctbal, 0.25) AS b1, quantile_cont(c_acctbal, 0.75) AS b3 FROM dedup)""") + """
SELECT o_orderkey, o_orderstatus,
       round(least(greatest(o_totalprice, a1 - 1.5 * (a3 - a1)), a3 + 1.5 * (a3 - a1)), 6) AS o_totalprice,
       o_orderpriority,
       round(least(greatest(c_acctbal, b1 - 1.5 * (b3 - b1)), b3 + 1.5 * (b3 - b1)), 6) AS c_acctbal,
       c_mktsegment
FROM dedup, f""")
def c11_preprocess(spark, sf_dir):
    out, _ = clean.preprocess(order_subject(spark, sf_dir), ORDER_ROLES)
    return out.withColumns({"o_totalprice": r6("o_totalprice"), "c_acctbal": r6("c_acctbal")})


@query("c12_clean_raw", with_views(ORDER_SUBJECT_SQL) + """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS o_orderstatus,
       o_totalprice, o_orderpriority, c_acctbal, c_mktsegment FROM order_subject""")
def c12_clean_raw(spark, sf_dir):
    return clean.clean_raw(order_subject(spark, sf_dir), ORDER_ROLES)
