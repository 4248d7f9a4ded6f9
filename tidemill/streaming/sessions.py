"""Sessions of a user: events that follow each other within a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.streaming.windows import cents


def session_windows(events: DataFrame, gap: str, bucket: str = "1 day") -> DataFrame:
    """``user_id, first_ts, last_ts, n, total_cents`` of every session of a table.

    An event belongs to the session of the one before if it is at most ``gap`` later. Sessions
    are first formed inside buckets of time (longer than the gap), so the events of one user
    spread over as many groups as there are buckets. Only the first and the last session of a
    user and bucket can go on in another bucket; they meet in a second step, at most two rows a
    bucket, and carry an open session over any number of buckets. All other sessions are
    complete. Events without a time are left out; a null user is a user.
    """
    span = F.expr(f"interval {gap}")
    timed = events.filter(F.col("ts").isNotNull()).select(
        "user_id", "ts", cents(F.col("value")).alias("cents"), F.window(F.col("ts"), bucket).getField("start").alias("bucket")
    )
    local = _joined(
        timed.select("user_id", "bucket", F.col("ts").alias("first_ts"), F.col("ts").alias("last_ts"), F.lit(1).cast("bigint").alias("n"), F.col("cents").alias("total_cents")),
        ["user_id", "bucket"], span,
    )
    ends = Window.partitionBy("user_id", "bucket")
    edge = (F.col("first_ts") == F.min("first_ts").over(ends)) | (F.col("last_ts") == F.max("last_ts").over(ends))
    marked = local.withColumn("edge", edge)
    columns = ["user_id", "first_ts", "last_ts", "n", "total_cents"]
    carried = _joined(marked.filter("edge").select(*columns), ["user_id"], span)
    return marked.filter("not edge").select(*columns).unionByName(carried.select(*columns))


def _joined(parts: DataFrame, keys: list[str], span) -> DataFrame:
    """Merge the parts of a group that are at most the gap apart; they do not overlap."""
    order = Window.partitionBy(*keys).orderBy("first_ts", "last_ts")
    new = F.when(F.col("first_ts") <= F.lag("last_ts").over(order) + span, 0).otherwise(1)
    numbered = parts.withColumn("_new", new).withColumn("_session", F.sum("_new").over(order))
    return numbered.groupBy(*keys, "_session").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n").alias("n"), F.sum("total_cents").alias("total_cents")
    ).drop("_session")


def closed_sessions(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """The same columns on a stream, for the sessions that no event can extend any more.

    A session is given out once the latest event is ``delay`` past the session's end, which is
    its last event and the gap.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).filter(F.col("ts").isNotNull()).withWatermark("ts", delay)
    found = timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(
        F.max("ts").cast("timestamp_ntz").alias("last_ts"), F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("total_cents")
    )
    return found.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("first_ts"), "last_ts", "n", "total_cents")
