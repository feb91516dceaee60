"""Sinks (S4-S8).  All writes are distributed (one file per task); nothing is
collected to the driver except the tiny metrics table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> str:
    """Write a processed / scored table.  CSV gets a header."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_splits(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> str:
    """One table with a ``split`` column, partitioned on it, so a reader of
    ``split='test'`` prunes the other directory."""
    return write_table(df, path, fmt=fmt, partition_by=[split_col])


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(f"{split_col} = '{split}'")


def save_metrics(metrics: DataFrame, path: str) -> str:
    """The metrics table (one row per model) as a single CSV file."""
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
