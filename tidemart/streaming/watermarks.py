"""Event-time columns with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _watermarked(df: DataFrame, name: str, seconds: int) -> DataFrame:
    return df.withWatermark(name, f"{seconds} seconds")


def row_time(df: DataFrame, seconds: int = 5) -> DataFrame:
    """Event time from ``ts_ms``, late by five seconds at most."""
    return _watermarked(df.withColumn("row_time", F.timestamp_millis("ts_ms")), "row_time", seconds)


def block_time(df: DataFrame, seconds: int) -> DataFrame:
    """T4: event time from ``block_timestamp`` if present, else ``timestamp`` (seconds)."""
    epoch = F.coalesce("block_timestamp", "timestamp")
    return _watermarked(df.withColumn("event_time", F.timestamp_seconds(epoch)), "event_time", seconds)


def batch_time(df: DataFrame, seconds: int, items: str = "items") -> DataFrame:
    """T5: event time of a list, the ``window_start_time`` (ms) of its first item."""
    first = F.get(F.col(items), F.lit(0))["window_start_time"]
    return _watermarked(df.withColumn("event_time", F.timestamp_millis(first)), "event_time", seconds)
