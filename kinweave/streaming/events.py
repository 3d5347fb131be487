"""Structured Streaming over the events: windows, sessions and de-duplication.

Each job reads the files once (``availableNow``), keeps its state under the shared
folder, and leaves a Parquet table. A rerun with the same state folder reads new files only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.session import working_dir


def event_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Events as they come, ``ts`` as event time."""
    schema = spark.read.parquet(path).schema
    glob = f"{path[:-1]}[{path[-1]}]"  # a pattern may name one file, a plain path must be a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(glob).withColumn("ts", F.col("ts").cast("timestamp"))


def hourly(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Counts and sums by kind and hour."""
    keyed = events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "event_type")
    return keyed.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("window.start").alias("hour"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user."""
    keyed = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap))
    return keyed.agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("begin"), "n")


def first_seen(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event id once, whatever is sent again within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def run_to_table(stream: DataFrame, mode: str, name: str, state: str | None = None) -> DataFrame:
    """Runs the stream over the files there are and reads back what it wrote.

    In complete mode each batch replaces the table; in append mode batches are added by
    Spark's file sink, which commits each batch once.
    """
    spark = stream.sparkSession
    base = state or f"{working_dir(spark)}/kinweave/stream-{name}-{uuid.uuid4().hex}"
    out = f"{base}/table"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    if mode == "complete":
        writer = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
    else:
        writer = writer.format("parquet").option("path", out)
    writer.start().awaitTermination()
    return spark.read.parquet(out)
