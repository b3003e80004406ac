"""Continuous ingestion of the behaviour log with Structured Streaming.

The cleaning rules are the batch ones (operators.clean): they are plain projections and
filters, so the same functions run unchanged on a streaming DataFrame. Cleaned rows are
appended to a parquet folder (exactly-once through the checkpoint location, which must be
on shared storage), from which the batch jobs compute features, index, pairs and ranks.

``user_activity_stream`` keeps the per-user running aggregate (last time, count, score) as
streaming state, one entry per user - the same state the batch feature job builds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cartograph.operators.clean import clean_text, clean_typed
from cartograph.operators.features import user_activity


def clean_log_stream(spark: SparkSession, source: str, fmt: str = "text",
                     schema: str | None = None, max_files_per_trigger: int | None = None
                     ) -> DataFrame:
    """Streaming clean log from a folder of raw text files (or typed files with ``schema``)."""
    reader = spark.readStream.format(fmt)
    if schema:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(source)
    return clean_text(df) if fmt == "text" else clean_typed(df)


def ingest_clean_log(clean_stream: DataFrame, path: str, checkpoint_location: str,
                     available_now: bool = True) -> StreamingQuery:
    """Append the cleaned rows to parquet; ``available_now`` drains what is there and stops."""
    writer = (clean_stream.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()


def user_activity_stream(clean_stream: DataFrame) -> DataFrame:
    """Running (user_id, max_ts, last_ts, cnt, score_sum); use outputMode("update").

    The aggregate has no watermark: it keeps one state row per user for ever, so a long run needs
    a state store on disk (RocksDB).
    """
    return user_activity(clean_stream).select(
        "user_id", "max_ts", "last_ts", "cnt", "score_sum")
