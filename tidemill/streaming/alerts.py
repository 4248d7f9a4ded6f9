"""Alerts from the state of a user: several events within a span of time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

ALERTS = "user_id bigint, event_id bigint, ts_micros bigint, n bigint"


class Burst(StatefulProcessor):
    """Keeps the times of the last span of a user; a timer forgets them when the span is over."""

    def __init__(self, least: int, span_micros: int):
        self.least, self.span = least, span_micros

    def init(self, handle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["ts_micros", "event_id"])
        before = np.array([at for (at,) in self.recent.get()], np.int64)
        times = np.sort(np.concatenate([before, new["ts_micros"].to_numpy(np.int64)]))
        own = new["ts_micros"].to_numpy(np.int64)
        n = np.searchsorted(times, own, "right") - np.searchsorted(times, own - self.span, "right")
        keep = times[times > times[-1] - self.span]
        self.recent.put([(int(at),) for at in keep])
        self.handle.registerTimer(self._over(int(times[-1])))
        found = n >= self.least
        if found.any():
            yield pd.DataFrame({"user_id": key[0], "event_id": new["event_id"].to_numpy()[found], "ts_micros": own[found], "n": n[found]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = [at for (at,) in self.recent.get()]
        if at and self._over(max(at)) <= expiredTimerInfo.getExpiryTimeInMs():
            self.recent.clear()
        return iter([])

    def _over(self, at: int) -> int:
        """The millisecond by which nothing at ``at`` counts any more."""
        return -(-(at + self.span) // 1000)


def bursts(events: DataFrame, event_type: str, least: int, span: str, delay: str) -> DataFrame:
    """``user_id, event_id, ts, n``: events of a type that are at least the ``least``-th of
    their user within ``span`` before them, themselves and events of the same time included.

    Events have to come in the order of their times, apart from those of one micro-batch; one
    behind the watermark is dropped. Events without a time or a user are left out. A user's
    state is the times of its last span; it is removed by a timer in event time. (Time-to-live
    runs on the clock of the machine, which has no meaning for events of the past.)
    """
    micros = int(events.sparkSession.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {span}"))).first()[0])
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).filter(
        F.col("ts").isNotNull() & F.col("user_id").isNotNull() & (F.col("event_type") == event_type)
    ).withWatermark("ts", delay)
    rows = timed.select("user_id", "event_id", "ts", F.unix_micros("ts").alias("ts_micros"))
    found = rows.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=Burst(least, micros), outputStructType=ALERTS, outputMode="Append", timeMode="EventTime"
    )
    return found.select("user_id", "event_id", F.timestamp_micros("ts_micros").cast("timestamp_ntz").alias("ts"), "n")
