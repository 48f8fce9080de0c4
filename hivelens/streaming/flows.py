"""Structured Streaming over the same event columns as in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hivelens.operators.sessions import GAP_SECONDS


def read_event_files(spark: SparkSession, folder: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of Parquet event files of a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def stream_sessions(events: DataFrame, lateness: str = "1 hour", seconds: int = GAP_SECONDS) -> DataFrame:
    """Gap sessions of a stream: they end, and are given out, once the watermark passes their gap. They may span batches."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    out = rows.groupBy(F.session_window("ts", f"{seconds} seconds"), "src_ip", "sensor").agg(F.count("*").alias("events"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
    return out.drop("session_window")


def stream_daily_counts(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Events of each address, sensor and UTC day, given out when the day is over."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return rows.groupBy(F.window("ts", "1 day"), "src_ip", "sensor").agg(F.count("*").alias("events")).select(F.to_date("window.start").alias("day"), "src_ip", "sensor", "events")


def distinct_events(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Events without repeats of an id that arrive within the lateness."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])


def run_batches(stream: DataFrame, checkpoint: str, out: str, step: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Writes step(batch) of each micro-batch into out/batch=<id>, replacing it, so a repeated batch changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_append(stream: DataFrame, checkpoint: str, out: str) -> StreamingQuery:
    """Writes a stream of finished rows as Parquet."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
