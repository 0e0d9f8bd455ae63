"""Structured Streaming forms: activity regions by session windows, and counts of event windows with late data dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_regions(stream: DataFrame, key: str, time: str, gap: str, lateness: str) -> DataFrame:
    """Regions of events no more than ``gap`` apart for each key, given out once the watermark has passed them."""
    return (
        stream.withWatermark(time, lateness)
        .groupBy(key, F.session_window(time, gap).alias("w"))
        .agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count("*").alias("n"))
        .select(key, "start", "end", "n")
    )


def window_levels(stream: DataFrame, time: str, level: str, width: str, slide: str, lateness: str, by: list[str] | None = None) -> DataFrame:
    """Count, mean square and peak of a level over sliding windows."""
    w = F.window(time, width, slide)
    return (
        stream.withWatermark(time, lateness)
        .groupBy(w.alias("w"), *(by or []))
        .agg(F.count("*").alias("n"), F.sqrt(F.avg(F.col(level) * F.col(level))).alias("rms"), F.max(F.abs(level)).alias("peak"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *(by or []), "n", "rms", "peak")
    )
