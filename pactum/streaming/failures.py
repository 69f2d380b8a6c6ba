"""Failure rate over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def failure_rate(failures: DataFrame, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Failures per stage and time window; works on a stream and on a table."""
    return (
        failures.withWatermark("failed_at", late)
        .groupBy(F.window("failed_at", size).alias("w"), "stage")
        .agg(F.count("*").alias("failures"))
        .select(F.col("w.start").alias("window_start"), "stage", "failures")
    )


def start_failure_rate(
    failures: DataFrame, out: str, checkpoint: str, size: str = "1 hour", late: str = "1 hour"
) -> StreamingQuery:
    """Append each window of streamed failures once it is closed, exactly once.

    A window is closed when a failure later than its end by more than ``late`` has
    been read. A failure that comes after the window it belongs to was closed is
    dropped; open windows are state, and wait for later failures across restarts.
    Failures without a time belong to no window.
    """
    return (
        failure_rate(failures, size, late).writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())


def read_failure_rate(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema("window_start timestamp, stage string, failures bigint").parquet(out)
