"""Captures as a stream: duplicates within a watermark, and running counts per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.dedup import url_hash


def new_records(stream: DataFrame, at: str = "captured_at", delay: str = "3 days") -> DataFrame:
    """The first record per address within the watermark; state is dropped as the watermark passes."""
    return stream.withColumn("url_hash", url_hash()).withWatermark(at, delay).dropDuplicatesWithinWatermark(["url_hash"])


def windowed_counts(stream: DataFrame, at: str, key: str, width: str = "1 day", delay: str = "3 days") -> DataFrame:
    """(window_start, key, n): late rows count until the watermark passes their window."""
    return (
        stream.withWatermark(at, delay).groupBy(F.window(at, width), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), key, "n")
    )


def sessions(stream: DataFrame, at: str, key: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """(key, session_start, n): session windows with a gap."""
    return (
        stream.withWatermark(at, delay).groupBy(F.session_window(at, gap), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("session_window.start").alias("session_start"), "n")
    )
