"""Registered queries: sinks S4-S7 and the CSV scan S2, as write -> read round trips in
the shared folder named by ``spark.checkpoint.dir`` (the oracle is the query that
produced the written table)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskframe.plans import queries_clean, queries_eval, queries_explain, queries_features
from riskframe.plans.catalog import ORACLE, ORDER_SUBJECT_SQL, query, with_views
from riskframe.plans.subjects import order_subject
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources import sinks
from riskframe.sources.tables import read_csv, read_csv_permissive


def _scratch(spark, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@query("s4_processed_sink", ORACLE["c11_preprocess"])
def s4_processed_sink(spark, sf_dir):
    out = queries_clean.c11_preprocess(spark, sf_dir)
    path = sinks.write_table(out, _scratch(spark, "processed"))
    return spark.read.parquet(path)


@query("s5_split_sink", ORACLE["r2_stratified_split"].replace(
    "SELECT doc_id, label, split FROM sp", "SELECT doc_id, label, split FROM sp WHERE split = 'test'"))
def s5_split_sink(spark, sf_dir):
    parted = queries_features._doc_split(spark, sf_dir).select("doc_id", "label", "split")
    path = sinks.write_splits(parted, _scratch(spark, "splits"))
    # reading one split prunes the other partition directory
    return sinks.read_split(spark, path, "test").select("doc_id", "label", "split")


@query("s6_metrics_sink", ORACLE["v11_metrics_table"])
def s6_metrics_sink(spark, sf_dir):
    m = queries_eval.v11_metrics_table(spark, sf_dir)
    path = sinks.save_metrics(m, _scratch(spark, "metrics"))
    return spark.read.schema(m.schema).option("header", True).csv(path)


@query("s7_predictions_sink", ORACLE["p1_batch_score"])
def s7_predictions_sink(spark, sf_dir):
    p = queries_explain.doc_scored(spark, sf_dir)
    path = sinks.write_table(p, _scratch(spark, "predictions"))
    return spark.read.parquet(path)


ORDER_SCHEMA = ("o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, "
                "c_acctbal double, c_mktsegment string, c_nationkey int")


@query("s2_csv_scan", ORACLE["c12_clean_raw"])
def s2_csv_scan(spark, sf_dir):
    """Write the raw order table as CSV with a header, scan it back with the declared
    schema, then clean it like the scoring path (C12)."""
    from riskframe.operators import clean
    from riskframe.plans.subjects import ORDER_ROLES

    path = sinks.write_table(order_subject(spark, sf_dir), _scratch(spark, "raw-csv"), fmt="csv")
    raw = read_csv(spark, path, ORDER_SCHEMA, label_optional=True)
    return clean.clean_raw(raw, ORDER_ROLES).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "c_acctbal",
        F.col("c_mktsegment"))


@query("s3_permissive_scan", with_views(ORDER_SUBJECT_SQL) + """
SELECT coalesce(o_orderpriority, '') AS o_orderpriority, o_orderkey % 5 = 0 AS broken, count(*) AS n, round(sum(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_totalprice END), 2) AS price
FROM order_subject GROUP BY ALL""")
def s3_permissive_scan(spark, sf_dir):
    """Orders as a CSV without the target, each fifth key with a price that is no number: good rows and rejected lines."""
    broken = F.col("o_orderkey") % 5 == 0
    raw = order_subject(spark, sf_dir).select("o_orderkey", "o_orderpriority", F.when(broken, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"))
    path = sinks.write_table(raw, _scratch(spark, "broken-csv"), fmt="csv")
    rows, rejected = read_csv_permissive(spark, path, "o_orderkey long, o_orderpriority string, o_totalprice double, o_orderstatus string", label_optional=True)
    good = rows.where("o_orderstatus is null").select("o_orderpriority", F.lit(False).alias("broken"), F.col("o_totalprice").alias("price"))
    bad = rejected.select(F.nullif(F.split_part("line", F.lit(","), F.lit(2)), F.lit("")).alias("o_orderpriority"), F.lit(True).alias("broken"), F.lit(0.0).alias("price"))
    both = good.unionByName(bad).withColumn("o_orderpriority", F.coalesce("o_orderpriority", F.lit("")))
    return both.groupBy("o_orderpriority", "broken").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("price"))
