"""Shared-folder tables and byte files for the operators of this subpackage.

Everything an operator writes between its steps goes below ``spark.checkpoint.dir`` (the folder the
cluster shares), never to a machine-local folder, so a lost executor loses nothing that was written.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir

#: An empty Zstandard skippable frame (magic 0x184D2A50, length 0).  It is plain ASCII, so the text sink can
#: write it after every row as "line separator", and every Zstandard reader skips it.
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)


#: Arrow batches of the jobs that this module starts: rows and bytes at most (a single longer row is a batch of its own).
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside hand whole texts to Python in small batches: a task holds a batch several times (JVM, pipe, Arrow,
    Python objects), and allocators keep the largest that they have seen."""
    before = {k: spark.conf.get(k, None) for k in BATCH}
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made.  Only for those that nothing reads any more, lost tasks included: whatever was made of
    them must be written itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """Like ``written``, as a table bucketed by a column: what groups or joins by it reads it without an exchange."""
    spark, table_name = df.sparkSession, f"llm_{name}_{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.format("parquet").option("path", scratch(spark, name)).bucketBy(buckets, by).saveAsTable(table_name)
    return spark.table(table_name)


def skippable(payload: bytes, magic: int) -> bytes:
    return struct.pack("<II", magic, len(payload)) + payload


def write_frames(frames: DataFrame, path: str) -> None:
    """One file per partition: the ``frame`` bytes of its rows in row order, each followed by ``EMPTY_FRAME``.

    The text sink copies the bytes of the string unchanged, goes through Spark's commit protocol (a retried or
    speculated task leaves no second file) and reaches every store that Spark can write.
    """
    with small_batches(frames.sparkSession):
        frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME.decode("ascii")).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of every non-empty file that ``write_frames`` wrote."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def hash_sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The rows of the ``n`` smallest distinct hashes of ``key``, one row for each (a bounded training sample).

    Only hashes are ordered; rows are filtered by the n-th of them, so no task or driver gets more than the sample.
    """
    hashed = df.withColumn("__hash", F.xxhash64(key))
    cut = hashed.select("__hash").distinct().orderBy("__hash").limit(n).agg(F.max("__hash")).first()[0]
    return hashed.where(F.col("__hash") <= F.lit(cut).cast("long")).dropDuplicates(["__hash"]).orderBy("__hash").drop("__hash")
