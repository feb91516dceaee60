"""Collects every registered query module and the flagship plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.plans import (  # noqa: F401  (each module registers its queries)
    queries_clean,
    queries_eval,
    queries_explain,
    queries_features,
    queries_model,
    queries_pipeline,
    queries_profile,
    queries_sinks,
)
from riskframe.plans.catalog import ORACLE, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.operators import clean, profile
    from riskframe.plans.subjects import DOC_ROLES, doc_subject

    prepared, _ = clean.preprocess(doc_subject(spark, sf_dir), DOC_ROLES)
    return profile.positive_rate(prepared, ["lang", "source"], "label")


__all__ = ["QUERIES", "ORACLE", "flagship"]
