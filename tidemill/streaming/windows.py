"""Counts over windows of event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cents(value: Column) -> Column:
    """Exact sums do not depend on the order of rows."""
    return F.round(value * 100).cast("bigint")


def window_counts(events: DataFrame, keys: list[str], delay: str, length: str, slide: str | None = None) -> DataFrame:
    """``keys, window_start, window_end, n, total_cents`` of the windows of ``length``.

    Windows begin every ``slide``, or follow each other without one. On a stream a window is
    given out once the latest event is ``delay`` past its end; later events of it are dropped.
    A table gives all windows. Events without a time belong to no window; a null key is a key.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).filter(F.col("ts").isNotNull()).withWatermark("ts", delay)
    counted = timed.groupBy(*keys, F.window("ts", length, slide)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("total_cents")
    )
    return counted.select(
        *keys,
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "n",
        "total_cents",
    )
