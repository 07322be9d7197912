"""Drain a folder of recorded answers: what has been read is remembered in a checkpoint, so a rerun resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import grounding

RESPONSES = "doc_id long, page_num int, width int, height int, raw_response string"


def elements(spark: SparkSession, folder: str) -> DataFrame:
    """Elements of the recorded page answers (Parquet) that arrive in a folder; stateless, so in any output mode."""
    return grounding.parse(spark.readStream.schema(RESPONSES).parquet(folder))


def drain(found: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, written once as Parquet; the checkpoint makes a rerun go on from there."""
    query = found.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def event_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Beyond parity: events (ts, event_type, value) per type and tumbling window, for streams and batches alike."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    out = events.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))
