"""Events of two streams that follow each other within a span of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def followed_by(first: DataFrame, second: DataFrame, span_seconds: int, delay: str) -> DataFrame:
    """``user_id, first_id, first_ts, second_id, second_ts``: pairs of one user's events, the
    second at the same time or at most ``span_seconds`` later.

    Both sides need ``user_id, event_id, ts``. They are keyed by user and span of time: a first
    event stands in its own span and the next one, so every pair meets once, and the events of
    one user spread over the spans. On streams the range of times in the condition and the
    watermarks let Spark forget an event once nothing can follow it. Events without a time or a
    user have no pair.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        timed = rows.withColumn("ts", F.col("ts").cast("timestamp")).filter(F.col("ts").isNotNull() & F.col("user_id").isNotNull())
        return timed.withWatermark("ts", delay).select(
            F.col("user_id").alias(f"{name}_user"), F.col("event_id").alias(f"{name}_id"), F.col("ts").alias(f"{name}_ts"),
            F.floor(F.unix_seconds("ts") / span_seconds).alias("own"),
        )

    left = side(first, "first").withColumn("first_span", F.explode(F.array(F.col("own"), F.col("own") + 1))).drop("own")
    right = side(second, "second").withColumnRenamed("own", "second_span")
    within = (F.col("second_ts") >= F.col("first_ts")) & (F.col("second_ts") <= F.col("first_ts") + F.expr(f"interval {span_seconds} seconds"))
    met = left.join(right, (F.col("first_user") == F.col("second_user")) & (F.col("first_span") == F.col("second_span")) & within)
    return met.select(
        F.col("first_user").alias("user_id"), "first_id", F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
        "second_id", F.col("second_ts").cast("timestamp_ntz").alias("second_ts"),
    )
