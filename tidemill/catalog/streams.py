"""Streams over the events table, replayed as files that arrive one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.catalog.base import Catalog
from tidemill.runtime import scratch_path
from tidemill.streaming.alerts import bursts
from tidemill.streaming.clicks import followed_by
from tidemill.streaming.feed import drained, files, replay, stream_session
from tidemill.streaming.restate import DailyTotals
from tidemill.streaming.sessions import closed_sessions, session_windows
from tidemill.streaming.windows import window_counts

SLICES = 4
DELAY = "2 hours"
_MARK = "SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR AS mark FROM events"
_CENTS = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents"


def _arrivals(t, by: str = "ts", rows: DataFrame | None = None):
    """The session for the stream, and the events as files in the order of ``by``, a slice a micro-batch."""
    rows = t.events if rows is None else rows
    folder = scratch_path(t.spark, "arrivals")
    per_batch = replay(rows, folder, by, SLICES)
    session = stream_session(t.spark)
    return session, folder, rows.schema, per_batch


def _text(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return df


def _time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def _windows(length: str, slide: str | None):
    def build(t) -> DataFrame:
        counted = window_counts(files(*_arrivals(t)), ["event_type"], DELAY, length, slide)
        return _text(drained(t.spark, counted, "window-counts"), "window_start", "window_end")

    return build


def _windows_sql(hours: int, slide: int) -> str:
    starts = f"unnest(generate_series(time_bucket(INTERVAL {slide} HOUR, ts) - INTERVAL {hours - slide} HOUR, ts, INTERVAL {slide} HOUR))"
    return f"""WITH m AS ({_MARK}), w AS (SELECT event_type, value, {starts} AS s FROM events)
    SELECT event_type, {_time('s')} AS window_start, {_time(f's + INTERVAL {hours} HOUR')} AS window_end, count(*) AS n, {_CENTS}
    FROM w, m WHERE s + INTERVAL {hours} HOUR <= mark GROUP BY event_type, s"""


def _late(t) -> DataFrame:
    """Every tenth event arrives a day and a half late."""
    delay = F.when(F.col("event_id") % 10 == 0, F.expr("interval 36 hours")).otherwise(F.expr("interval 0 hours"))
    return t.events.withColumn("arrived", F.col("ts") + delay)


def restated(t) -> DataFrame:
    totals = DailyTotals(scratch_path(t.spark, "daily-totals"), "event_type")
    totals.follow(files(*_arrivals(t, "arrived", _late(t))))
    return totals.read(t.spark).select(F.col("day").cast("string").alias("day"), "event_type", "n", "total_cents")


_SESSIONS = f"""SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n, {_CENTS} FROM (
    SELECT *, sum(CASE WHEN ts <= before + INTERVAL 30 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)) GROUP BY user_id, s"""
_SESSION_COLUMNS = f"user_id, {_time('first')} AS first_ts, {_time('last')} AS last_ts, n, total_cents"


def clicks(t) -> DataFrame:
    arrivals = _arrivals(t)
    sides = [files(*arrivals).filter(F.col("event_type") == kind) for kind in ("click", "purchase")]
    return _text(drained(t.spark, followed_by(*sides, 3600, DELAY), "click-pairs"), "first_ts", "second_ts")


def register(catalog: Catalog) -> None:
    add = catalog.add
    add("window_counts_stream", _windows("1 hour", None), _windows_sql(1, 1))
    add("sliding_counts_stream", _windows("1 day", "6 hours"), _windows_sql(24, 6))
    add("late_restatement", restated,
        f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, {_CENTS} FROM events GROUP BY CAST(ts AS DATE), event_type")
    add("session_windows", lambda t: _text(session_windows(t.events, "30 minutes"), "first_ts", "last_ts"), f"SELECT {_SESSION_COLUMNS} FROM ({_SESSIONS})")
    add("session_windows_stream",
        lambda t: _text(drained(t.spark, closed_sessions(files(*_arrivals(t)), "30 minutes", DELAY), "sessions"), "first_ts", "last_ts"),
        f"WITH m AS ({_MARK}) SELECT {_SESSION_COLUMNS} FROM ({_SESSIONS}), m WHERE last + INTERVAL 30 MINUTE <= mark")
    add("user_state_alerts",
        lambda t: _text(drained(t.spark, bursts(files(*_arrivals(t)), "error", 3, "2 days", DELAY), "alerts"), "ts"),
        f"""SELECT user_id, event_id, {_time('ts')} AS ts, n FROM (SELECT *, count(*) OVER (
        PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '2 days' - INTERVAL '1 microsecond' PRECEDING AND CURRENT ROW) AS n
        FROM events WHERE event_type = 'error' AND user_id IS NOT NULL AND ts IS NOT NULL) WHERE n >= 3""")
    add("stream_join_clicks", clicks,
        f"""SELECT c.user_id, c.event_id AS first_id, {_time('c.ts')} AS first_ts, p.event_id AS second_id, {_time('p.ts')} AS second_ts
        FROM events c JOIN events p ON c.user_id = p.user_id AND c.event_type = 'click' AND p.event_type = 'purchase'
        AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR""")
