"""Scans (S1-S3): explicit schemas, Parquet by default, CSV with a header."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

# Declared schemas of the driver tables (no inference on read).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S1 (Parquet twin): scan one driver table with its declared schema."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(table_path(sf_dir, name))


def _require(path: str) -> None:
    """Fail early (like the original loader) when a local path is absent; remote URIs
    are left to the reader."""
    local = path[len("file:"):] if path.startswith("file:") else path
    if ":" in local.split("/")[0] or "://" in local:
        return
    if not os.path.exists(local):
        raise FileNotFoundError(f"there is no file {path}")


def read_csv(spark: SparkSession, path: str, schema: str | StructType, label_optional: bool = False) -> DataFrame:
    """CSV with header and a declared schema.  ``label_optional``: declared columns that the header does not
    name (the target of a scoring file) are read as null; the header decides the order of the others."""
    _require(path)
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    declared = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    if not label_optional:
        return reader.schema(declared).csv(path)
    header = spark.read.option("header", True).csv(path).columns  # reads the first line only
    by_name = {f.name: f for f in declared.fields}
    present = StructType([by_name.get(c) or StructField(c, StringType()) for c in header])
    rows = reader.schema(present).option("enforceSchema", False).csv(path)
    return rows.select([F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in declared.fields])


def read_csv_permissive(spark: SparkSession, path: str, schema: str | StructType, label_optional: bool = False) -> tuple[DataFrame, DataFrame]:
    """S2/S3 for scoring files that may hold broken lines: (rows, rejected).

    A line is broken if a value does not parse as its declared type or if its number of fields is not the header's; broken
    lines are left out of the rows and come back whole in ``rejected`` (file, line).  Both are one narrow scan of the file,
    so a bad line neither ends the batch nor goes unseen.  ``label_optional`` as in ``read_csv``."""
    _require(path)
    declared = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    header = spark.read.option("header", True).csv(path).columns  # reads the first line only
    by_name = {f.name: f for f in declared.fields}
    missing = [f.name for f in declared.fields if f.name not in header]
    if missing and not label_optional:
        raise ValueError(f"the header of {path} does not name {missing}")
    corrupt = "__broken"
    present = StructType([*(by_name.get(c) or StructField(c, StringType()) for c in header), StructField(corrupt, StringType())])
    scan = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
            .option("enforceSchema", False).schema(present).csv(path))
    # true of every row: keeps all columns in the scan, so that a value that is not asked for is still checked
    scan = scan.where(F.xxhash64(*[F.col(f"`{c}`") for c in header]) >= F.lit(-(1 << 63)))
    rows = scan.where(F.col(corrupt).isNull()).select([F.col(f"`{f.name}`") if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
                                                       for f in declared.fields])
    return rows, scan.where(F.col(corrupt).isNotNull()).select(F.input_file_name().alias("file"), F.col(corrupt).alias("line"))


def read_parquet(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    _require(path)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
