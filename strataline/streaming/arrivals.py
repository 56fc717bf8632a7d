"""Records as they arrive: each id once, and counts by window, with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_arrivals(stream: DataFrame, key: str, when: str, late: str = "1 hour") -> DataFrame:
    """Rows whose ``key`` hasn't been seen within the watermark; state older than that is dropped."""
    return stream.withWatermark(when, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, when: str, by: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """``window_start``, ``by`` and ``n`` of each closed window."""
    counted = stream.withWatermark(when, late).groupBy(F.window(when, width), by).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), by, "n")
