from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import inactivity
from millrace.schemas import PROCESSING_EVENT
from millrace.streaming import stations, windows
from tests.conftest import at, millis

DAY = "2026-01-30 "
PERIOD = 600


def batch(spark, times):
    rows = [(at(DAY + t), 1, 2, i, "IN") for i, t in enumerate(times)]
    events = spark.createDataFrame(rows, PROCESSING_EVENT)
    return events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("event_id", F.col("unit_id"))


def seen(alerts):
    return sorted(r.timestamp for r in alerts if r.line == 1)


def ms(*times):
    return [millis(at(DAY + t)) for t in times]


CASES = [
    (["12:00:00"], "12:10:01", ["12:00:00"]),
    (["12:00:00", "12:09:50"], "12:10:01", []),
    (["12:00:00", "12:10:05", "12:09:50"], "12:20:06", ["12:10:05"]),
    (["12:00:00", "12:10:05", "12:20:10"], "12:30:15", ["12:00:00", "12:10:05", "12:20:10"]),
    # A gap of exactly the period.
    (["12:00:00", "12:10:00"], "12:15:00", ["12:00:00"]),
]


@pytest.mark.parametrize("times, until, expected", CASES)
def test_buffered_batch(spark, times, until, expected):
    for rows_per_slice in (None, 1):
        alerts = inactivity.inactivity_buffered(
            batch(spark, times), PERIOD, at(DAY + until), rows_per_slice=rows_per_slice
        )
        rows = alerts.collect()
        assert seen(rows) == ms(*expected)
        assert all((r.line, r.station) == (1, 2) for r in rows)


def test_in_order_batch(spark):
    for times, until, expected in CASES[:2]:
        assert seen(inactivity.inactivity_in_order(batch(spark, times), PERIOD, at(DAY + until)).collect()) == ms(
            *expected
        )
    # An event at the very end of the period cancels the alert.
    assert seen(inactivity.inactivity_in_order(batch(spark, ["12:00:00", "12:10:00"]), PERIOD).collect()) == ms(
        "12:10:00"
    )


def test_end_of_input_alerts_for_every_station(spark):
    assert seen(inactivity.inactivity_buffered(batch(spark, ["12:00:00"]), PERIOD).collect()) == ms("12:00:00")


def event(time, line=1):
    return {"ts": at(DAY + time), "line": line, "station": 2, "unit_id": 1, "action": "IN"}


# Steps: times of station (1, 2), or the watermark another line brings ("@").
STREAM_CASES = [
    (["12:00:00", "@12:10:01"], ["12:00:00"]),
    (["12:00:00", "12:09:50", "@12:10:01"], []),
    (["12:00:00 12:10:05 12:09:50", "@12:10:01", "@12:10:06", "@12:20:06"], ["12:10:05"]),
    (["12:00:00 12:10:05 12:20:10", "@12:30:15"], ["12:00:00", "12:10:05", "12:20:10"]),
    (["12:00:00 12:10:00", "@12:15:00"], ["12:00:00"]),
]


def play_steps(play, steps):
    rows = []
    for step in steps:
        line = 99 if step.startswith("@") else 1
        rows = play.feed(events=[event(t, line) for t in step.lstrip("@").split()])
    return rows


@pytest.mark.parametrize("steps, expected", STREAM_CASES)
def test_buffered_stream(player, steps, expected):
    play = player(events=PROCESSING_EVENT)
    play.start(stations.inactivity_buffered(windows.in_order(play.stream("events")), PERIOD))
    assert seen(play_steps(play, steps)) == ms(*expected)


@pytest.mark.parametrize("steps, expected", STREAM_CASES)
def test_sessions_stream(player, steps, expected):
    play = player(events=PROCESSING_EVENT)
    play.start(stations.inactivity_sessions(windows.in_order(play.stream("events")), PERIOD))
    assert seen(play_steps(play, steps)) == ms(*expected)


@pytest.mark.parametrize("steps, expected", STREAM_CASES[:2])
def test_in_order_stream(player, steps, expected):
    play = player(events=PROCESSING_EVENT)
    play.start(stations.inactivity_in_order(windows.in_order(play.stream("events")), PERIOD))
    assert seen(play_steps(play, steps)) == ms(*expected)


def test_in_order_stream_alerts_again_after_new_activity(player):
    play = player(events=PROCESSING_EVENT)
    play.start(stations.inactivity_in_order(windows.in_order(play.stream("events")), PERIOD))
    rows = play_steps(play, ["12:00:00", "@12:11:00", "12:12:00", "@12:23:00"])
    assert seen(rows) == ms("12:00:00", "12:12:00")


def test_late_event_is_dropped_by_the_buffered_stream(player):
    play = player(events=PROCESSING_EVENT)
    play.start(stations.inactivity_buffered(windows.in_order(play.stream("events")), PERIOD))
    rows = play_steps(play, ["12:00:00", "@12:05:00", "12:04:00", "@12:10:30"])
    assert seen(rows) == ms("12:00:00")


@pytest.mark.parametrize("form", ["inactivity_buffered", "inactivity_sessions"])
def test_stream_equals_batch(spark, player, form):
    """Random events of a few stations, out of order within the bound, over three micro-batches."""
    rng = random.Random(7)
    start = at(DAY + "00:00:00")
    rows = [(start + timedelta(seconds=150 * i + rng.randrange(900)), rng.randrange(3), rng.randrange(2), i, "IN") for i in range(240)]
    names = ["ts", "line", "station", "unit_id", "action"]
    play = player(events=PROCESSING_EVENT)
    play.start(getattr(stations, form)(windows.with_disorder(play.stream("events"), "20 minutes"), PERIOD))
    got = []
    for part in range(0, 240, 80):
        got = play.feed(events=[dict(zip(names, r)) for r in rows[part : part + 80]])
    end = start + timedelta(days=2)
    got = play.feed(events=[dict(zip(names, (end, 99, 0, -1, "IN")))])
    events = spark.createDataFrame(rows, PROCESSING_EVENT).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    batch_rows = inactivity.inactivity_buffered(events, PERIOD, tie="unit_id").collect()
    assert len(batch_rows) > 20
    assert sorted(tuple(r) for r in got if r.line != 99) == sorted(tuple(r) for r in batch_rows)
