from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import counts
from millrace.schemas import PROCESSING_EVENT
from millrace.streaming import windows
from tests.conftest import at, millis

DAY = "2026-01-30 "
# (line, unit, time) of events that leave station 1 of 2, and line, window start, count.
CASES = [
    ([(0, 1, "12:00:29"), (0, 2, "12:01:06")], [(0, "12:00:00", 2)]),
    ([(0, 1, "12:02:00"), (0, 2, "12:07:00")], [(0, "12:00:00", 1), (0, "12:05:00", 1)]),
    ([(0, 1, "12:02:00"), (1, 2, "12:02:00")], [(0, "12:00:00", 1), (1, "12:00:00", 1)]),
]


def expected_rows(expected):
    starts = [(line, millis(at(DAY + start)), count) for line, start, count in expected]
    return [(line, ms, ms + 300_000, count) for line, ms, count in starts]


@pytest.mark.parametrize("given, expected", CASES)
def test_window_counts(spark, given, expected):
    events = spark.createDataFrame([(at(DAY + t), line, 1, unit, "OUT") for line, unit, t in given], PROCESSING_EVENT)
    got = counts.in_millis(counts.units_per_window(events, 2)).collect()
    assert sorted(tuple(r) for r in got) == expected_rows(expected)


def test_only_the_last_station_and_out_count(spark):
    rows = [(at(DAY + "12:00:01"), 0, 1, 1, "IN"), (at(DAY + "12:00:02"), 0, 0, 1, "OUT")]
    assert counts.units_per_window(spark.createDataFrame(rows, PROCESSING_EVENT), 2).count() == 0


def test_window_is_half_open(spark):
    rows = [(at(DAY + "12:05:00"), 0, 1, 1, "OUT"), (at(DAY + "12:04:59.999"), 0, 1, 2, "OUT")]
    got = counts.units_per_window(spark.createDataFrame(rows, PROCESSING_EVENT), 2).collect()
    assert sorted((r["window_start"], r["count"]) for r in got) == [
        (at(DAY + "12:00:00"), 1),
        (at(DAY + "12:05:00"), 1),
    ]


@pytest.mark.parametrize("given, expected", CASES)
def test_window_counts_in_a_stream(player, given, expected):
    play = player(events=PROCESSING_EVENT)
    play.start(counts.in_millis(windows.units_per_window(play.stream("events"), 2)))
    rows = [
        {"ts": at(DAY + t), "line": line, "station": 1, "unit_id": unit, "action": "OUT"} for line, unit, t in given
    ]
    play.feed(events=rows)
    # An IN event of another line moves the watermark, though it is not counted.
    got = play.feed(events=[{"ts": at(DAY + "13:00:00"), "line": 99, "station": 0, "unit_id": 0, "action": "IN"}])
    assert sorted(tuple(r) for r in got) == expected_rows(expected)


def test_late_rows_are_dropped_in_a_stream(player):
    play = player(events=PROCESSING_EVENT)
    play.start(counts.in_millis(windows.units_per_window(play.stream("events"), 2)))

    def out(unit, time, line=0):
        return {"ts": at(DAY + time), "line": line, "station": 1, "unit_id": unit, "action": "OUT"}

    play.feed(events=[out(1, "12:01:00")])
    # 10 s of disorder: the window is still open at 12:05:09 and closed at 12:05:10.
    assert play.feed(events=[out(2, "12:05:09", 99)]) == []
    play.feed(events=[out(3, "12:04:00")])
    play.feed(events=[out(4, "12:05:10", 99)])
    play.feed(events=[out(5, "12:03:00")])
    got = play.feed(events=[out(6, "13:00:00", 99)])
    assert [r["count"] for r in got if r["line"] == 0] == [2]


def test_arrival_watermark_and_late_rows(spark):
    times = ["12:00:00", "12:04:00", "12:02:00", "12:05:10", "12:04:59", "12:06:00"]
    rows = [(at(DAY + t), 0, 1, i, "OUT") for i, t in enumerate(times)]
    events = spark.createDataFrame(rows, PROCESSING_EVENT).withColumn("event_id", F.col("unit_id"))
    for rows_per_slice in (None, 1):
        marked = counts.arrival_watermark(events, 10, rows_per_slice=rows_per_slice)
        marks = {r.event_id: r.watermark for r in marked.collect()}
        assert marks == {
            0: None,
            1: at(DAY + "11:59:50"),
            2: at(DAY + "12:03:50"),
            3: at(DAY + "12:03:50"),
            4: at(DAY + "12:05:00"),
            5: at(DAY + "12:05:00"),
        }
        assert sorted(r.event_id for r in counts.without_late(marked).collect()) == [0, 1, 2, 3, 5]


def test_partial_counts_merge(spark):
    """The count is built up per partition and merged, so it does not depend on how rows are spread."""
    rows = [(at(DAY + "12:00:01"), i % 2, 1, i, "OUT") for i in range(100)]
    events = spark.createDataFrame(rows, PROCESSING_EVENT)
    for partitions in (1, 7):
        counted = counts.units_per_window(events.repartition(partitions), 2)
        assert sorted((r["line"], r["count"]) for r in counted.collect()) == [(0, 50), (1, 50)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_stream_equals_batch(spark, player):
    rng = random.Random(9)
    start = at(DAY + "12:00:00")
    rows = [
        (start + timedelta(seconds=7 * i + rng.randrange(60)), rng.randrange(3), rng.randrange(2), i, rng.choice(["IN", "OUT"]))
        for i in range(300)
    ]
    names = ["ts", "line", "station", "unit_id", "action"]
    play = player(events=PROCESSING_EVENT)
    play.start(counts.in_millis(windows.units_per_window(play.stream("events"), 2, bound="1 minute")))
    for part in range(0, 300, 100):
        play.feed(events=[dict(zip(names, r)) for r in rows[part : part + 100]])
    got = play.feed(events=[dict(zip(names, (start + timedelta(days=1), 99, 1, -1, "OUT")))])
    batch = counts.in_millis(counts.units_per_window(spark.createDataFrame(rows, PROCESSING_EVENT), 2))
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in batch.collect())
