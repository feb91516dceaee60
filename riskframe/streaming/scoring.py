"""Continuous scoring (P1 on a stream).

New raw files arriving in a folder are scored with the fitted PipelineModel and
appended to a sink.  The plan is the same narrow, shuffle-free scoring plan as the
batch path; Structured Streaming adds exactly-once file output through the checkpoint
location (which must be on shared storage: it is what makes a restarted query resume
after driver or executor loss).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskframe.operators import clean, score
from riskframe.spec import Roles


def score_stream(spark: SparkSession, source_dir: str, schema: str, roles: Roles, model: PipelineModel,
                 add_features: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet",
                 threshold: float = 0.5, max_files_per_trigger: int | None = None,
                 profile: clean.Profile | None = None) -> DataFrame:
    """Streaming DataFrame of scored rows (input columns + Prediction + Probability)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(source_dir)
    return score.score_table(raw, roles, model, (), add_features, profile, threshold)


def start(scored: DataFrame, sink_dir: str, checkpoint_dir: str, fmt: str = "parquet",
          available_now: bool = True, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append the scored stream to ``sink_dir`` (file sink: exactly once per batch)."""
    w = scored.writeStream.format(fmt).option("path", sink_dir).option("checkpointLocation", checkpoint_dir) \
        .outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
