import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemill.streaming import feed
from tidemill.streaming.alerts import bursts
from tidemill.streaming.clicks import followed_by
from tidemill.streaming.restate import DailyTotals
from tidemill.streaming.sessions import closed_sessions, session_windows
from tidemill.streaming.windows import window_counts

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


@pytest.fixture
def stream(spark, tmp_path):
    """Files that arrive one after the other, each from rows ``(event_id, minute, user, type, value)``."""

    class Stream:
        session, folder = feed.stream_session(spark), str(tmp_path / "arrivals")

        def add(self, *rows):
            made = [(i, None if m is None else at(m), u, k, v) for i, m, u, k, v in rows]
            self.session.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

        def read(self):
            return feed.files(self.session, self.folder, self.session.createDataFrame([], SCHEMA).schema)

        def table(self):
            return self.session.read.schema(SCHEMA).parquet(self.folder)

        def drain(self, df, name):
            return feed.drain(df, str(tmp_path / name), str(tmp_path / f"{name}-progress"))

        def progress(self, df, name):
            query = df.writeStream.format("noop").option("checkpointLocation", str(tmp_path / f"{name}-progress")).trigger(availableNow=True).start()
            query.awaitTermination()
            return query.recentProgress

    return Stream()


def random_events(seed, n, users=5, span=3000, kinds=("click", "purchase", "error")):
    rng = random.Random(seed)
    minutes = sorted(rng.randrange(span) for _ in range(n))
    return [(i, m, rng.choice([0, 0, 0, *range(users)]), rng.choice(kinds), rng.randrange(10_000) / 100) for i, m in enumerate(minutes)]


def test_a_row_behind_the_watermark_is_dropped(stream):
    stream.add((0, 600, 1, "a", 1.0))
    stream.add((1, 750, 1, "a", 2.0))
    stream.add((5, 751, 1, "a", 0.5))  # the mark a batch is held against is the one known before the batch ahead of it
    stream.add((2, 550, 1, "a", 4.0), (3, 720, 1, "a", 8.0), (4, 900, 1, "a", 16.0))
    counted = lambda df: window_counts(df, ["event_type"], "1 hour", "1 hour")
    got = {(r.window_start, r.n, r.total_cents) for r in stream.drain(counted(stream.read()), "w").collect()}
    # Row 2 came when its window was over; row 3 was late too, but its window was still open.
    assert got == {(at(600), 1, 100), (at(720), 3, 1050)}
    whole = {(r.window_start, r.n) for r in counted(stream.table()).collect()}
    assert whole == {(at(540), 1), (at(600), 1), (at(720), 3), (at(900), 1)}


def test_a_continued_run_writes_no_window_twice(stream):
    events = random_events(1, 200)
    counted = lambda: window_counts(stream.read(), ["event_type"], "10 minutes", "2 hours", "1 hour")
    seen = []
    for part in (events[:70], events[70:120], events[120:]):
        stream.add(*part)
        seen.append(stream.drain(counted(), "w").count())
    got = sorted(map(tuple, stream.drain(counted(), "w").collect()), key=repr)
    mark = at(events[-1][1] - 10)
    want = sorted(map(tuple, window_counts(stream.table(), ["event_type"], "10 minutes", "2 hours", "1 hour").filter(F.col("window_end") <= F.lit(mark)).collect()), key=repr)
    assert got == want and seen == sorted(seen) and len(set(got)) == len(got)


def test_replay_keeps_every_row_and_the_order(spark, tmp_path):
    rows = spark.createDataFrame([(i, at(i * 7 % 100) if i % 9 else None) for i in range(200)], "id long, ts timestamp_ntz")
    feed.replay(rows, str(tmp_path / "a"), "ts", 4)
    paths = sorted((tmp_path / "a").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    slices = [spark.read.parquet(str(p)).agg(F.min("ts"), F.max("ts")).first() for p in paths]
    timed = [(a, b) for a, b in slices if a is not None]
    assert spark.read.parquet(str(tmp_path / "a")).count() == 200 and len(timed) >= 4
    borders = [at(99 * k / 4) for k in range(1, 4)]
    numbers = [sum(a >= x for x in borders) for a, _ in timed]
    assert numbers == sorted(numbers) and numbers == [sum(b >= x for x in borders) for _, b in timed]
    feed.replay(rows.limit(0), str(tmp_path / "b"), "ts", 4)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 0


def listing(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_restated_days(spark, stream, tmp_path):
    totals = DailyTotals(str(tmp_path / "totals"), "event_type")
    events = random_events(2, 150, span=4 * 1440)
    read = lambda: sorted(tuple(r) for r in totals.read(spark).select("day", "event_type", "n", "total_cents").collect())
    exact = lambda: sorted(tuple(r) for r in stream.table().filter("ts is not null").groupBy(F.to_date("ts"), "event_type").agg(
        F.count("*"), F.sum(F.round(F.col("value") * 100).cast("bigint"))).collect())
    for part in (events[:60], events[60:], [(900, None, 1, "a", 1.0)]):
        stream.add(*part)
        totals.follow(stream.read())
        assert read() == exact()

    # The same batch again changes nothing.
    before = read()
    batch = stream.session.createDataFrame([(i, at(m), u, k, v) for i, m, u, k, v in events[60:]], SCHEMA)
    totals.apply(batch, 1)
    assert read() == before

    # A late batch writes its own day only.
    files = listing(totals.table)
    stream.add((901, 30, 1, "error", 5.0))
    totals.follow(stream.read())
    after = listing(totals.table)
    assert read() == exact() and read() != before
    changed = {os.path.basename(os.path.dirname(p)) for p in files.keys() ^ after.keys()}
    assert changed == {"day=2024-01-01"} and all(after[p] == files[p] for p in files.keys() & after.keys())


def brute_sessions(events, gap):
    out = []
    for user in {e[2] for e in events}:
        mine = sorted((m, v) for _, m, u, _, v in events if u == user and m is not None)
        session = []
        for m, v in mine:
            if session and m - session[-1][0] > gap:
                out.append((user, session))
                session = []
            session.append((m, v))
        if session:
            out.append((user, session))
    return sorted((u, at(s[0][0]), at(s[-1][0]), len(s), sum(round(v * 100) for _, v in s)) for u, s in out)


@pytest.mark.parametrize("bucket", ["1 hour", "1 day"])
@pytest.mark.parametrize("n", [40, 400])
def test_sessions_of_tables_and_streams(stream, n, bucket):
    events = random_events(n, n) + [(5000, None, 1, "a", 1.0)]
    stream.add(*events[: n // 2])
    stream.add(*events[n // 2 :])
    want = brute_sessions(events, 30)
    assert sorted(map(tuple, session_windows(stream.table(), "30 minutes", bucket).collect())) == want
    mark = at(max(m for _, m, *_ in events if m is not None) - 10)
    closed = stream.drain(closed_sessions(stream.read(), "30 minutes", "10 minutes"), "s").collect()
    assert sorted(map(tuple, closed)) == [s for s in want if s[2] + dt.timedelta(minutes=30) <= mark]


def test_a_session_over_very_many_buckets(spark):
    rows = spark.range(5000).select(F.expr("7 + id div 1000000").alias("user_id"), (F.timestamp_seconds(F.col("id") * 600)).alias("ts"), F.lit(0.01).alias("value"))
    got = session_windows(rows, "10 minutes", "1 hour").collect()
    assert [(r.user_id, r.n, r.total_cents) for r in got] == [(7, 5000, 5000)]
    plan = session_windows(rows, "10 minutes", "1 hour")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(user_id#\d+L?, bucket#", plan)


def brute_bursts(events, least, span):
    errors = [(u, i, m) for i, m, u, k, _ in events if k == "error" and u is not None and m is not None]
    out = [(u, i, at(m), sum(v == u and m - span < x <= m for v, _, x in errors)) for u, i, m in errors]
    return sorted(r for r in out if r[3] >= least)


def test_alerts_and_a_restart(stream):
    events = random_events(3, 300) + [(900, 3500, None, "error", 1.0), (901, None, 1, "error", 1.0)]
    ordered = sorted(events, key=lambda e: (e[1] is None, e[1] or 0))
    alerts = lambda: bursts(stream.read(), "error", 3, "2 hours", "1 minute")
    cuts = [0, 80, 81, 200, 303]
    for b, e in zip(cuts, cuts[1:]):
        # Events of one minute arrive together, as the contract of the operator asks.
        part = [x for x in ordered if (b <= ordered.index(next(y for y in ordered if y[1] == x[1])) < e)]
        if part:
            stream.add(*part)
        got = stream.drain(alerts(), "a").collect()
    assert sorted(map(tuple, got)) == brute_bursts(events, 3, 120) and got


@pytest.mark.parametrize("rows_per_file", [10, 1_000])
def test_alerts_of_a_table_replayed_from_many_partitions(spark, stream, tmp_path, rows_per_file):
    # All of the first slice, none of the second, few rows in the third.
    minutes = [*range(0, 700, 2), 1500, 1501, 1502, *range(2200, 2999, 9), 3000]
    events = [(i, m, i % 5, "error", 1.0) for i, m in enumerate(minutes)]
    made = [(i, at(m), u, k, v) for i, m, u, k, v in events]
    rows = stream.session.createDataFrame(made, SCHEMA).repartition(6)
    folder = str(tmp_path / "replayed")
    per_batch = feed.replay(rows, folder, "ts", 4, rows_per_file=rows_per_file)
    assert (per_batch > 1) == (rows_per_file == 10)
    read = feed.files(stream.session, folder, rows.schema, per_batch)
    got = feed.drained(spark, bursts(read, "error", 3, "2 hours", "1 minute"), "alerts")
    assert sorted(map(tuple, got.collect())) == brute_bursts(events, 3, 120)


def test_timers_let_the_state_go(stream):
    for k in range(4):
        stream.add(*[(100 * k + i, 1440 * k + i, 100 * k + i, "error", 1.0) for i in range(50)])
    stream.add((999, 1440 * 5, 1, "click", 1.0), (1000, 1440 * 5, 1, "error", 1.0))
    rows = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in stream.progress(bursts(stream.read(), "error", 3, "2 hours", "1 minute"), "a")]
    kept = [r for r in rows if r]
    assert kept and max(kept) < 4 * 50 * 3 and kept[-1] <= 110


def test_click_pairs_and_their_state(stream):
    events = random_events(4, 400, span=4000)
    for b in range(0, 400, 50):
        stream.add(*events[b : b + 50])
    stream.add((990, 9000, 1, "click", 1.0), (991, 9000, 1, "purchase", 1.0), (992, None, 1, "click", 1.0), (993, 9000, None, "click", 1.0))
    sides = lambda rows: [rows.filter(F.col("event_type") == k) for k in ("click", "purchase")]
    every = events + [(990, 9000, 1, "click", 1.0), (991, 9000, 1, "purchase", 1.0)]
    want = sorted((u, i, at(m), j, at(x)) for i, m, u, k, _ in every for j, x, v, l, _ in every if k == "click" and l == "purchase" and u == v and m <= x <= m + 60)
    assert sorted(map(tuple, stream.drain(followed_by(*sides(stream.read()), 3600, "10 minutes"), "c").collect())) == want
    assert sorted(map(tuple, followed_by(*sides(stream.table()), 3600, "10 minutes").collect())) == want
    rows = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in stream.progress(followed_by(*sides(stream.read()), 3600, "10 minutes"), "state")]
    # Clicks are kept twice; without forgetting, all of some 400 events would be held at the end.
    assert max(rows) < 200 and rows[-1] <= 10
