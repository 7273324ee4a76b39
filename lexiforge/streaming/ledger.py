"""Streaming views of the task ledger (an extension: the batch operators cover the engine's needs).

Both work on a stream of events with an event time: status changes are folded per task, counts are kept per window, and
the watermark bounds the state in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(events: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The last value of each key so far; for the update or complete output mode."""
    return events.groupBy(key).agg(F.max_by(value, order).alias(value), F.max(order).alias(order))


def windowed_counts(events: DataFrame, time: str, key: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """(window_start, key, n) per tumbling window; rows later than the watermark are left out."""
    rows = events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n"))
    return rows.select(F.col("w.start").alias("window_start"), key, "n")
