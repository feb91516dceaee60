"""Registered queries: features F1-F12, encoding E1-E6, split / folds / weights
(R2, R3, M4, M8, A18) and SMOTE (R4-R7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.exprs import flag, ratio_plus_one
from riskframe.operators import encode, features, profile, sample
from riskframe.plans.catalog import (DOC_SUBJECT_SQL, LINE_SUBJECT_SQL, ORDER_SUBJECT_SQL, query, r6, with_views)
from riskframe.plans.subjects import ORDER_PRIORITY_LEVELS, doc_subject, line_subject, order_subject, vec_subject

# level vocabularies used by the line-level features (natural order of the domain)
PRIORITY_SCORES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}
STATUS_SCORES = {"O": 1, "F": 2}


def line_features(df):
    """F1-F11 as generic builders over line_subject columns (same shapes as the
    employee formulas: ratios over x+1, a row mean of level scores, level products,
    flags and flag products)."""
    merged = {**PRIORITY_SCORES, **STATUS_SCORES}
    return {
        "f1_price_per_qty": ratio_plus_one("l_extendedprice", "l_quantity"),
        "f2_level_mean": features.row_mean_of_levels(df, ["o_orderpriority", "l_linestatus", "p_size"], merged),
        "f3_acct_per_total": ratio_plus_one("c_acctbal", "o_totalprice"),
        "f4_qty_x_priority": features.times_level(df, "l_quantity", "o_orderpriority", PRIORITY_SCORES),
        "f5_growth": features.growth_ratio("l_quantity", "l_linenumber"),
        "f6_building": features.flag_or_zero(df, "c_mktsegment", "BUILDING"),
        "f7_price_per_size": ratio_plus_one("p_retailprice", "p_size"),
        "f8_building_x_urgency": features.flag_times_inverse_level(df, "c_mktsegment", "BUILDING", "o_orderpriority",
                                                                   PRIORITY_SCORES, top=6),
        "f9_line_per_qty": ratio_plus_one("l_linenumber", "l_quantity"),
        "f10_total_per_qty": ratio_plus_one("o_totalprice", "l_quantity"),
        "f11_size_x_building": features.flag_times(df, "p_size", "c_mktsegment", "BUILDING"),
    }


def _case(col: str, mapping: dict) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items()) + " END"


_P = _case("o_orderpriority", PRIORITY_SCORES)
_V = [f"COALESCE({_case('o_orderpriority', {**PRIORITY_SCORES, **STATUS_SCORES})}, TRY_CAST(o_orderpriority AS DOUBLE))",
      f"COALESCE({_case('l_linestatus', {**PRIORITY_SCORES, **STATUS_SCORES})}, TRY_CAST(l_linestatus AS DOUBLE))",
      "COALESCE(NULL, TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE))"]
_BUILDING = "COALESCE(CAST(c_mktsegment = 'BUILDING' AS INTEGER), 0)"


@query("f12_features", with_views(LINE_SUBJECT_SQL) + f"""
SELECT line_key,
  CAST(l_extendedprice AS DOUBLE) / (CAST(l_quantity AS DOUBLE) + 1.0) AS f1_price_per_qty,
  (COALESCE(CAST({_V[0]} AS DOUBLE), 0.0) + COALESCE(CAST({_V[1]} AS DOUBLE), 0.0) + COALESCE(CAST({_V[2]} AS DOUBLE), 0.0))
    / NULLIF(CAST((CAST({_V[0]} IS NOT NULL AS INTEGER) + CAST({_V[1]} IS NOT NULL AS INTEGER)
                  + CAST({_V[2]} IS NOT NULL AS INTEGER)) AS DOUBLE), 0.0) AS f2_level_mean,
  CAST(c_acctbal AS DOUBLE) / (CAST(o_totalprice AS DOUBLE) + 1.0) AS f3_acct_per_total,
  l_quantity * COALESCE({_P}, 2) AS f4_qty_x_priority,
  CAST(l_quantity - l_linenumber AS DOUBLE) / (CAST(l_quantity AS DOUBLE) + 1.0) AS f5_growth,
  {_BUILDING} AS f6_building,
  CAST(p_retailprice AS DOUBLE) / (CAST(p_size AS DOUBLE) + 1.0) AS f7_price_per_size,
  {_BUILDING} * (6 - COALESCE({_P}, 2)) AS f8_building_x_urgency,
  CAST(l_linenumber AS DOUBLE) / (CAST(l_quantity AS DOUBLE) + 1.0) AS f9_line_per_qty,
  CAST(o_totalprice AS DOUBLE) / (CAST(l_quantity AS DOUBLE) + 1.0) AS f10_total_per_qty,
  p_size * {_BUILDING} AS f11_size_x_building
FROM line_subject""")
def f12_features(spark, sf_dir):
    ls = line_subject(spark, sf_dir)
    return features.add_features(ls, line_features(ls)).select("line_key", *line_features(ls).keys())


# ----------------------------------------------------------------- encoding --
@query("e1_ordinal_encode", with_views(LINE_SUBJECT_SQL) + """
SELECT line_key, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
       WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 ELSE -1 END AS DOUBLE) AS ordinal__o_orderpriority
FROM line_subject""")
def e1_ordinal_encode(spark, sf_dir):
    ls = line_subject(spark, sf_dir)
    enc = encode.EncoderModel(ordinal={"o_orderpriority": ORDER_PRIORITY_LEVELS})
    return enc.transform(ls, keep=["line_key"])


SPLIT_ORDERS_SQL = """
sp AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey)
                          <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
       FROM order_subject)"""
SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")  # AUTOMOBILE (first, sorted) is dropped


def _orders_train(spark, sf_dir):
    s = sample.split(order_subject(spark, sf_dir), "o_orderkey", None, 0.2, 42, stratify=False)
    return s, s.where(F.col("split") == "train")


@query("e2_onehot_encode", with_views(ORDER_SUBJECT_SQL, SPLIT_ORDERS_SQL) + """
SELECT o_orderkey, """ + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END AS onehot__c_mktsegment_{s}" for s in SEGMENTS) + """
FROM sp""")
def e2_onehot_encode(spark, sf_dir):
    allrows, train = _orders_train(spark, sf_dir)
    enc = encode.fit_encoder(train, {}, ["c_mktsegment"], [])
    return enc.transform(allrows, keep=["o_orderkey"])


SCALE_SQL = """
st AS (SELECT avg(o_totalprice) AS m1, stddev_pop(o_totalprice) AS s1, avg(c_acctbal) AS m2, stddev_pop(c_acctbal) AS s2
       FROM sp WHERE split = 'train')"""


@query("e3_standard_scale", with_views(ORDER_SUBJECT_SQL, SPLIT_ORDERS_SQL, SCALE_SQL) + """
SELECT o_orderkey, round((o_totalprice - m1) / s1, 6) AS scaler__o_totalprice,
       round((c_acctbal - m2) / s2, 6) AS scaler__c_acctbal
FROM sp, st""")
def e3_standard_scale(spark, sf_dir):
    allrows, train = _orders_train(spark, sf_dir)
    enc = encode.fit_encoder(train, {}, [], ["o_totalprice", "c_acctbal"])
    out = enc.transform(allrows, keep=["o_orderkey"])
    return out.select("o_orderkey", *[r6(c).alias(c) for c in ("scaler__o_totalprice", "scaler__c_acctbal")])


@query("e4_column_transformer", with_views(ORDER_SUBJECT_SQL, SPLIT_ORDERS_SQL, SCALE_SQL) + """
SELECT o_orderkey, split,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
       WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 ELSE -1 END AS DOUBLE) AS ordinal__o_orderpriority, """ + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END AS onehot__c_mktsegment_{s}" for s in SEGMENTS) + """,
  round((o_totalprice - m1) / s1, 6) AS scaler__o_totalprice, round((c_acctbal - m2) / s2, 6) AS scaler__c_acctbal
FROM sp, st""")
def e4_column_transformer(spark, sf_dir):
    allrows, train = _orders_train(spark, sf_dir)
    enc = encode.fit_encoder(train, {"o_orderpriority": ORDER_PRIORITY_LEVELS}, ["c_mktsegment"],
                             ["o_totalprice", "c_acctbal"])
    out = enc.transform(allrows, keep=["o_orderkey", "split"])
    return out.withColumns({c: r6(c) for c in ("scaler__o_totalprice", "scaler__c_acctbal")})


@query("e5_feature_names", """
SELECT * FROM (VALUES (0, 'ordinal__o_orderpriority'), (1, 'onehot__c_mktsegment_BUILDING'),
  (2, 'onehot__c_mktsegment_FURNITURE'), (3, 'onehot__c_mktsegment_HOUSEHOLD'), (4, 'onehot__c_mktsegment_MACHINERY'),
  (5, 'scaler__o_totalprice'), (6, 'scaler__c_acctbal')) t(position, feature)""")
def e5_feature_names(spark, sf_dir):
    _, train = _orders_train(spark, sf_dir)
    enc = encode.fit_encoder(train, {"o_orderpriority": ORDER_PRIORITY_LEVELS}, ["c_mktsegment"],
                             ["o_totalprice", "c_acctbal"])
    names = enc.feature_names()
    return spark.createDataFrame(list(enumerate(names)), "position int, feature string")


@query("e6_align_columns", with_views(ORDER_SUBJECT_SQL) + """
SELECT o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, o_orderkey FROM order_subject""")
def e6_align_columns(spark, sf_dir):
    return encode.align_columns(order_subject(spark, sf_dir),
                                ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "o_orderkey"])


# ----------------------------------------------------------------- split -----
STRAT_SQL = """
cc AS (SELECT label, count(*) AS c FROM doc_subject GROUP BY label),
tot AS (SELECT sum(c) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(c)) AS BIGINT) AS n_test FROM cc),
tr AS (SELECT label, c, CAST((n - n_test) * c AS DOUBLE) / CAST(n AS DOUBLE) AS cont,
              floor(CAST((n - n_test) * c AS DOUBLE) / CAST(n AS DOUBLE)) AS fl, n - n_test AS n_train FROM cc, tot),
rem AS (SELECT label, c, fl + CASE WHEN row_number() OVER (ORDER BY cont - fl DESC, CAST(label AS VARCHAR))
                                   <= n_train - sum(fl) OVER () THEN 1 ELSE 0 END AS train_q FROM tr),
q AS (SELECT label, c - train_q AS quota FROM rem),
rk AS (SELECT d.*, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))), doc_id)
              AS rk FROM doc_subject d),
sp AS (SELECT rk.*, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split FROM rk JOIN q USING (label))"""


def _doc_split(spark, sf_dir):
    return sample.split(doc_subject(spark, sf_dir), "doc_id", "label", 0.2, 42, stratify=True)


@query("r2_stratified_split", with_views(DOC_SUBJECT_SQL, STRAT_SQL) + """
SELECT doc_id, label, split FROM sp""")
def r2_stratified_split(spark, sf_dir):
    return _doc_split(spark, sf_dir).select("doc_id", "label", "split")


@query("r3_random_split", with_views(ORDER_SUBJECT_SQL, SPLIT_ORDERS_SQL) + """
SELECT o_orderkey, split FROM sp""")
def r3_random_split(spark, sf_dir):
    allrows, _ = _orders_train(spark, sf_dir)
    return allrows.select("o_orderkey", "split")


@query("a18_split_rates", with_views(DOC_SUBJECT_SQL, STRAT_SQL) + """
SELECT split, count(*) AS n, round(avg(CAST(label AS DOUBLE)) * 100.0, 6) AS positive_pct FROM sp GROUP BY split""")
def a18_split_rates(spark, sf_dir):
    return profile.split_rates(_doc_split(spark, sf_dir), "label").withColumn("positive_pct", r6("positive_pct"))


@query("m8_fold_assignment", with_views(DOC_SUBJECT_SQL) + """
SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))),
       doc_id) - 1) % 5 AS INTEGER) AS fold
FROM doc_subject""")
def m8_fold_assignment(spark, sf_dir):
    return sample.assign_folds(doc_subject(spark, sf_dir), "doc_id", "label", 5, 42).select("doc_id", "label", "fold")


@query("m4_class_weights", with_views(DOC_SUBJECT_SQL) + """
SELECT doc_id, label, CAST((SELECT count(*) FROM doc_subject) AS DOUBLE)
       / (2 * count(*) OVER (PARTITION BY label)) AS weight
FROM doc_subject""")
def m4_class_weights(spark, sf_dir):
    return sample.balanced_weights(doc_subject(spark, sf_dir), "label").select("doc_id", "label", "weight")


# ----------------------------------------------------------------- SMOTE -----
MINORITY_SQL = """
mi AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x1, CAST(n_spaces AS DOUBLE) AS x2, CAST(n_newlines AS DOUBLE) AS x3
       FROM doc_subject WHERE label = 1),
pr AS (SELECT a.doc_id, b.doc_id AS nb_key,
              ((a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2)) + (a.x3 - b.x3) * (a.x3 - b.x3) AS dist2
       FROM mi a JOIN mi b ON a.doc_id <> b.doc_id),
kn AS (SELECT doc_id, CAST(j AS INTEGER) AS j, nb_key, dist2
       FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dist2, nb_key) AS j FROM pr) t WHERE j <= 5)"""


def _doc_points(spark, sf_dir):
    d = doc_subject(spark, sf_dir)
    return d.select("doc_id", "label", F.array(*[F.col(c).cast("double") for c in ("n_chars", "n_spaces", "n_newlines")])
                    .alias("x"))


@query("r5_minority_knn", with_views(DOC_SUBJECT_SQL, MINORITY_SQL) + """
SELECT doc_id, j, nb_key, dist2 FROM kn""")
def r5_minority_knn(spark, sf_dir):
    pts = _doc_points(spark, sf_dir).where(F.col("label") == 1)
    return sample.knn(pts, "doc_id", "x", 5)


@query("r5_embedding_knn", """
WITH mi AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings WHERE label = 0),
pr AS (SELECT a.vec_id, b.vec_id AS nb_key, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(a.v, b.v)]) AS dist2
       FROM mi a JOIN mi b ON a.vec_id <> b.vec_id)
SELECT vec_id, CAST(j AS INTEGER) AS j, nb_key, round(dist2, 9) AS dist2
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(dist2, 12), nb_key) AS j FROM pr) t WHERE j <= 5""")
def r5_embedding_knn(spark, sf_dir):
    pts = vec_subject(spark, sf_dir).where(F.col("target") == 1)
    return sample.knn(pts, "vec_id", "features_arr", 5).withColumn("dist2", F.round("dist2", 9))


@query("r4_smote", with_views(DOC_SUBJECT_SQL, MINORITY_SQL, """
cnt AS (SELECT sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS m, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS maj
        FROM doc_subject)""", """
ranked AS (SELECT doc_id AS b_key, x1, x2, x3,
                  row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))), doc_id) - 1 AS b_idx
           FROM mi)""", """
syn AS (SELECT s, md5(concat_ws(':', '42', 'smote', CAST(s AS VARCHAR))) AS h FROM (SELECT unnest(range(0, CAST(maj - m AS BIGINT))) AS s FROM cnt))""", """
syn2 AS (SELECT s, CAST(floor(CAST(('0x' || substr(h, 1, 13))::BIGINT AS DOUBLE) / 4503599627370496.0::DOUBLE
                        * CAST(m * 5 AS DOUBLE)) AS BIGINT) AS pick,
                CAST(('0x' || substr(h, 14, 13))::BIGINT AS DOUBLE) / 4503599627370496.0::DOUBLE AS gap FROM syn, cnt)""", """
syn3 AS (SELECT s, gap, pick // 5 AS b_idx, CAST(pick % 5 + 1 AS INTEGER) AS j FROM syn2)""") + """
SELECT -(s + 1) AS doc_id, 1 AS label, round(b.x1 + gap * (n.x1 - b.x1), 6) AS x1, round(b.x2 + gap * (n.x2 - b.x2), 6) AS x2,
       round(b.x3 + gap * (n.x3 - b.x3), 6) AS x3, true AS is_synthetic
FROM syn3 JOIN ranked b USING (b_idx) JOIN kn k ON k.doc_id = b.b_key AND k.j = syn3.j JOIN mi n ON n.doc_id = k.nb_key
UNION ALL
SELECT doc_id, label, CAST(n_chars AS DOUBLE), CAST(n_spaces AS DOUBLE), CAST(n_newlines AS DOUBLE), false FROM doc_subject""")
def r4_smote(spark, sf_dir):
    out = sample.smote(_doc_points(spark, sf_dir), "doc_id", "label", "x", k=5, seed=42)
    return out.select("doc_id", "label", *[r6(F.col("x")[i]).alias(f"x{i + 1}") for i in range(3)], "is_synthetic")


@query("r7_resampled_counts", with_views(DOC_SUBJECT_SQL) + """
SELECT label, false AS is_synthetic, count(*) AS n FROM doc_subject GROUP BY label
UNION ALL
SELECT 1, true, (SELECT count(*) FILTER (WHERE label = 0) - count(*) FILTER (WHERE label = 1) FROM doc_subject)""")
def r7_resampled_counts(spark, sf_dir):
    out = sample.smote(_doc_points(spark, sf_dir), "doc_id", "label", "x", k=5, seed=42)
    return out.groupBy("label", "is_synthetic").agg(F.count(F.lit(1)).alias("n"))
