"""Incremental statistics: the partial sums merge, so a stream of pixels keeps them up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators.stats import finalize, partial_stats


def running_stats(pixels: DataFrame, keys: list[str], x: str = "x") -> DataFrame:
    """Streaming partial statistics with their figures, in complete or update mode."""
    return finalize(partial_stats(pixels, keys, x))


def windowed_counts(events: DataFrame, ts: str, key: str, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows by event-time window and key; the watermark bounds the state."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, length), key).agg(F.count("*").alias("n"))
