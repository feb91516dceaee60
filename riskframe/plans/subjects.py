"""Subject tables derived from the driver tables (FIXTURES §4).

Each view is a plain DataFrame plan over the Parquet scans (joins on keys, no
broadcast hints on data-dependent sizes: AQE picks the strategy from runtime sizes).
The driver tables have no nulls, so null cases are made by an md5 mask of the key,
the same expression in Spark and in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.tables import read_table
from riskframe.spec import Roles


def md5_mask(key: str, hex_char: str) -> Column:
    """True for ~1/16 of keys: first md5 hex digit of the key equals ``hex_char``."""
    return F.substring(F.md5(F.col(key).cast("string")), 1, 1) == F.lit(hex_char)


def doc_subject(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    """documents ⋈ labels: target = 1 - quality (about 15 % positives); ``how`` "left" keeps documents without a label."""
    d = read_table(spark, sf_dir, "documents")
    lb = read_table(spark, sf_dir, "labels")
    j = d.join(lb, "doc_id", how)
    text = F.col("text")
    return j.select(
        "doc_id", "lang", "source", "n_chars",
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long").alias("n_spaces"),
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))).cast("long").alias("n_newlines"),
        F.col("toxic").cast("int").alias("toxic"),
        (F.lit(1) - F.col("quality")).cast("int").alias("label"),
    )


DOC_NUMERIC = ("n_chars", "n_spaces", "n_newlines")
DOC_ROLES = Roles(target="label", key="doc_id", numerical=DOC_NUMERIC, categorical=("lang", "source"),
                  onehot=("lang",), outlier=("n_chars",))


def order_subject(spark: SparkSession, sf_dir: str, masked: bool = True) -> DataFrame:
    """orders ⋈ customer, with ~1/16 of c_acctbal and c_mktsegment masked to null."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    acct = F.col("c_acctbal")
    seg = F.col("c_mktsegment")
    if masked:
        acct = F.when(md5_mask("o_orderkey", "0"), F.lit(None).cast("double")).otherwise(acct)
        seg = F.when(md5_mask("o_orderkey", "1"), F.lit(None).cast("string")).otherwise(seg)
    return j.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        acct.alias("c_acctbal"), seg.alias("c_mktsegment"), F.col("c_nationkey").cast("int").alias("c_nationkey"),
    )


# o_orderpriority levels in their natural order (fixed by the data domain)
ORDER_PRIORITY_LEVELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
ORDER_ROLES = Roles(
    target="o_orderstatus", key="o_orderkey",
    numerical=("o_totalprice", "c_acctbal"), categorical=("c_mktsegment",),
    ordinal={"o_orderpriority": ORDER_PRIORITY_LEVELS}, onehot=("c_mktsegment",),
    outlier=("o_totalprice", "c_acctbal"), target_map={"F": 1, "O": 0}, drop=("c_nationkey",),
)


def line_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ part; target = returnflag R and linestatus F."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    p = read_table(spark, sf_dir, "part")
    j = (li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
         .join(c, o["o_custkey"] == c["c_custkey"], "inner")
         .join(p, li["l_partkey"] == p["p_partkey"], "inner"))
    key = (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("line_key")
    prio = F.when(md5_mask("l_orderkey", "2"), F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
    return j.select(
        key, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber",
        "l_returnflag", "l_linestatus", prio.alias("o_orderpriority"), "o_totalprice",
        "c_acctbal", "c_mktsegment", "p_size", "p_retailprice", "p_type",
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).cast("int").alias("label"),
    )


def vec_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings: 64-wide float vectors, target label = 0 (about 10 %)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("features_arr"),
                    (F.col("label") == 0).cast("int").alias("target"))
