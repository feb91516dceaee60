"""Corpus pipeline: toxic documents go, one document of each near-duplicate group stays, leaked benchmark items go,
sources are mixed to their weights, and what is left becomes token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into the cluster's shared
folder and reads it again for the next stage.  All stages but the last return the columns of ``docs`` as they came.

Null or empty texts pass the filters (they are neither toxic by any term, nor near anything, nor leaked), take no words
in the mix and so leave it only if their copies are drawn; null ids are kept by the filters; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, minhash_join, mixing, tokens, toxicity
from riskframe.llm.store import scratch, table, written
from riskframe.llm.words import sized


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~toxicity.is_held_out("doc_id"))
    scored = toxicity.scored(docs, toxicity.train(docs, labels), name="__toxic")
    return scored.where(F.col("__toxic") < toxicity.THRESHOLD).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = written(minhash_join.classes(docs).select("id", "component"), "classes").where("id is not null")
    gone = found.where("id != component").select("id").distinct()
    twice = found.groupBy("id").agg(F.count("*").alias("n"), F.min("component").alias("c")).where("n > 1")
    once = docs.join(gone.union(twice.select("id")).withColumnRenamed("id", "__id"), F.col("doc_id") == F.col("__id"), "left_anti")
    # rows that repeat an id that stays: one of them
    again = docs.join(twice.where("id = c").select(F.col("id").alias("__id")), F.col("doc_id") == F.col("__id"), "left_semi")
    order = W.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    return once.unionByName(again.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select(F.col("id").alias("__id")).distinct(), F.col("doc_id") == F.col("__id"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(sized(docs, "text", "__size"), size_col="__size", prefix="__mix_")
    return mix.where("__mix_copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__mix_copies"))).select(docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch(spark, "pipeline-tokens")
    tokens.write_tokens(docs, path)
    return tokens.read_digests(spark, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", token_files),
]

#: A fitted model, signatures and token files are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
