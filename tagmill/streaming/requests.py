"""Windowed request rates and cool-down episodes on a stream of request rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.operators.requests import COOLDOWN_SECONDS, LIMITED


def with_event_time(log: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Event time as a zoned timestamp with a watermark (session time zone UTC is expected)."""
    return log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def tumbling_rates(log: DataFrame, width: str = "10 seconds") -> DataFrame:
    counted = log.groupBy(F.window("ts", width).alias("w"), "test_name").agg(
        F.count("*").alias("requests"), F.count_if(F.col("status_code") == LIMITED).alias("limited")
    )
    return counted.select("test_name", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "requests", "limited")


def busy_windows(log: DataFrame, width: str = "10 minutes", slide: str = "5 minutes", threshold: int = 700) -> DataFrame:
    """Sliding windows whose request count passes ``threshold``; in update mode a window appears once it does."""
    counted = log.groupBy(F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("requests"))
    return counted.where(F.col("requests") > threshold).select(
        F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "requests"
    )


def cooldown_sessions(log: DataFrame, gap_seconds: int = COOLDOWN_SECONDS) -> DataFrame:
    """Bursts of 429s per test, emitted once the watermark passes their end (append mode)."""
    # Naming the event time keeps this filter above the watermark, so every request moves the watermark, not only 429s.
    limited = log.where(F.when(F.col("status_code") == LIMITED, F.col("ts")).isNotNull())
    sessions = limited.groupBy("test_name", F.session_window("ts", f"{gap_seconds} seconds").alias("w")).agg(F.count("*").alias("errors"))
    last = F.unix_micros("w.end") - gap_seconds * 1_000_000
    return sessions.select("test_name", F.unix_micros("w.start").alias("start_us"), last.alias("last_us"), "errors")
