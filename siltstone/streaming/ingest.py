"""Incremental ingestion as structured streams.

The ledger of processed files is the stream's checkpoint: a file is read once, and a failed batch is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def stream(spark: SparkSession, folder: str, schema: str = EVENTS, glob: str = "events*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def ingest(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what is new to a Parquet table and stop."""
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(rows: DataFrame, window: str = "1 hour", slide: str | None = None, delay: str = "2 hours") -> DataFrame:
    """Events by window and type; late ones up to `delay` count."""
    frame = F.window("ts", window, slide) if slide else F.window("ts", window)
    return rows.withWatermark("ts", delay).groupBy(frame.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(rows: DataFrame, gap: str = "30 minutes", delay: str = "2 hours") -> DataFrame:
    """Events by session of a user."""
    return rows.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")


def first_only(rows: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Each event once, repeated ones within the delay dropped."""
    return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
