"""As-of and nearest joins: fixed cases, batch and stream, and agreement of the two."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.records import energy, reading
from millrace.operators import asof
from millrace.schemas import ENERGY_CONSUMPTION, PROCESSING_EVENT
from millrace.streaming import joins, windows
from tests.conftest import at

READINGS = "ts TIMESTAMP, line INT, station INT, energy DOUBLE"
EVENT_TS = at("2025-01-30 12:00:02.500")


def second(n: float):
    return at(f"2025-01-30 12:00:{n:06.3f}")


def events(spark, *times, keys=(1, 1)):
    rows = [(t, *keys, i, "IN") for i, t in enumerate(times)]
    return spark.createDataFrame(rows, PROCESSING_EVENT)


def readings(spark, pairs, keys=(1, 1)):
    return spark.createDataFrame([(t, *keys, float(v)) for t, v in pairs], READINGS)


CASES = [
    ([(second(0), 100), (second(1), 110), (second(2), 120), (second(3), 130)], 120.0),
    ([(at("2025-01-30 11:00:00"), 100)], 100.0),
    ([(second(3), 100)], None),
    ([], None),
]


@pytest.mark.parametrize("pairs, expected", CASES)
def test_asof_cases(spark, pairs, expected):
    joined = asof.asof_join(events(spark, EVENT_TS), readings(spark, pairs), event_tie="unit_id")
    assert [r.energy for r in joined.select("reading.energy").collect()] == [expected]


@pytest.mark.parametrize("pairs, expected", CASES)
def test_asof_cases_in_a_stream(player, pairs, expected):
    """The event arrives first, readings one per micro-batch; the result comes with the watermark."""
    play = player(events=PROCESSING_EVENT, readings=READINGS)
    play.start(
        joins.asof_join(
            windows.in_order(play.stream("events")), windows.in_order(play.stream("readings")), ["energy"]
        )
    )
    event = {"ts": EVENT_TS, "line": 1, "station": 1, "unit_id": 1, "action": "IN"}
    # A reading may not lie behind the watermark, so the old one comes before the event.
    early = [p for p in pairs if p[0] < second(0)]
    for ts, value in early:
        play.feed(readings=[{"ts": ts, "line": 1, "station": 1, "energy": value}])
    assert play.feed(events=[event]) == []
    for ts, value in pairs:
        if (ts, value) not in early:
            play.feed(readings=[{"ts": ts, "line": 1, "station": 1, "energy": value}])
    end = at("2025-01-30 12:00:30")
    play.feed(events=[{**event, "ts": end, "line": 99}])
    rows = play.feed(readings=[{"ts": end, "line": 99, "station": 1, "energy": 0}])
    assert [r.energy for r in rows if r.line == 1] == [expected]


def test_asof_takes_the_reading_of_the_same_instant_and_the_last_of_equals(spark):
    pairs = [(second(2.5), 1), (second(1), 9)]
    joined = asof.asof_join(events(spark, EVENT_TS), readings(spark, pairs), event_tie="unit_id")
    assert joined.select("reading.energy").first()[0] == 1.0
    tied = spark.createDataFrame(
        [(second(1), 1, 1, 5.0, 2), (second(1), 1, 1, 4.0, 1)], READINGS + ", reading_id BIGINT"
    )
    joined = asof.asof_join(events(spark, EVENT_TS), tied, event_tie="unit_id", reading_tie="reading_id")
    assert joined.select("reading.energy").first()[0] == 5.0


def test_asof_keeps_keys_apart(spark):
    joined = asof.asof_join(
        events(spark, EVENT_TS), readings(spark, [(second(1), 7)], keys=(1, 2)), event_tie="unit_id"
    )
    assert joined.first().reading is None


LATE_CASES = [
    (6, [(second(0), 100)], [100.0]),
    (10, [(second(0), 100)], []),
    (7, [(second(0), 100), (second(2), 120), (second(4), 140)], [120.0]),
]


@pytest.mark.parametrize("watermark, pairs, expected", LATE_CASES)
def test_lateness_cases(spark, watermark, pairs, expected):
    late = events(spark, EVENT_TS).withColumn("watermark", F.lit(second(watermark)))
    joined = asof.asof_join_with_lateness(late, readings(spark, pairs), 5, event_tie="unit_id")
    assert [r[0] for r in joined.select("reading.energy").collect()] == expected


def test_lateness_bound_is_strict(spark):
    late = events(spark, second(1), second(1.001)).withColumn("watermark", F.lit(second(6)))
    joined = asof.asof_join_with_lateness(late, readings(spark, []), 5, event_tie="unit_id")
    assert [r.unit_id for r in joined.collect()] == [1]


@pytest.mark.parametrize("watermark, pairs, expected", LATE_CASES)
def test_lateness_cases_in_a_stream(player, watermark, pairs, expected):
    play = player(events=PROCESSING_EVENT, readings=READINGS)
    play.start(
        joins.asof_join_with_lateness(play.stream("events"), play.stream("readings"), ["energy"], 0, 5)
    )
    event = {"ts": EVENT_TS, "line": 1, "station": 1, "unit_id": 1, "action": "IN"}
    play.feed(readings=[{"ts": t, "line": 1, "station": 1, "energy": v} for t, v in pairs])
    reached = second(watermark)
    play.feed(readings=[{"ts": reached, "line": 99, "station": 1, "energy": 0}])
    play.feed(events=[{**event, "ts": reached, "line": 99}])
    rows = play.feed(events=[event])
    assert [r.energy for r in rows if r.line == 1] == expected


def test_pruned_readings(spark):
    table = readings(spark, [(second(s), s) for s in (0, 1, 2, 3, 4)]).withColumn("reading_id", F.lit(0).cast("bigint"))
    kept = asof.prune_readings(table, F.lit(second(2.5)))
    assert sorted(r.energy for r in kept.collect()) == [2.0, 3.0, 4.0]


NEAREST = [
    ([(second(2), 1), (second(4), 2)], 1.0, 500),
    ([(second(0), 1), (second(3), 2)], 2.0, 500),
    ([(second(2), 1), (second(3), 2)], 1.0, 500),
    ([(second(2.5), 1), (second(2.6), 2)], 1.0, 0),
    ([(second(9), 3)], 3.0, 6500),
]


@pytest.mark.parametrize("pairs, expected, delta", NEAREST)
def test_nearest_cases(spark, pairs, expected, delta):
    joined = asof.nearest_join(events(spark, EVENT_TS), readings(spark, pairs), event_tie="unit_id")
    row = joined.select("reading.energy", "time_delta_ms").first()
    assert (row.energy, row.time_delta_ms) == (expected, delta)


def test_nearest_without_readings_gives_no_row(spark):
    joined = asof.nearest_join(events(spark, EVENT_TS), readings(spark, []), event_tie="unit_id")
    assert joined.count() == 0


def test_nearest_stream_sees_what_has_arrived(player):
    play = player(events=PROCESSING_EVENT, readings=READINGS)
    play.start(
        joins.nearest_join(
            windows.with_disorder(play.stream("events")), windows.with_disorder(play.stream("readings")), ["energy"]
        )
    )
    event = {"ts": EVENT_TS, "line": 1, "station": 1, "unit_id": 1, "action": "IN"}
    assert play.feed(events=[event]) == []
    play.feed(readings=[{"ts": second(1), "line": 1, "station": 1, "energy": 1}])
    rows = play.feed(events=[{**event, "unit_id": 2}])
    play.feed(readings=[{"ts": second(3), "line": 1, "station": 1, "energy": 2}])
    rows = play.feed(events=[{**event, "unit_id": 3, "ts": second(2.6)}])
    assert [(r.unit_id, r.energy, r.time_delta_ms) for r in sorted(rows, key=lambda r: r.unit_id)] == [
        (2, 1.0, 1500),
        (3, 2.0, 400),
    ]


def random_streams(n=400):
    rng = random.Random(5)
    rows, marks = [], []
    for i in range(n):
        # A third of everything at one station.
        keys = (0, 0) if i % 3 == 0 else (rng.randrange(2), rng.randrange(3))
        rows.append((at("2025-01-30 12:00:00").replace(minute=rng.randrange(60), second=rng.randrange(60), microsecond=i), *keys, i, "IN"))
        marks.append((at("2025-01-30 12:00:00").replace(minute=rng.randrange(60), second=rng.randrange(60), microsecond=1000 + i), *keys[:1], rng.randrange(3), float(i)))
    return rows, marks


def test_joins_do_not_depend_on_slices(spark):
    rows, marks = random_streams()
    left = spark.createDataFrame(rows, PROCESSING_EVENT)
    right = spark.createDataFrame(marks, READINGS)
    for join in (asof.asof_join, asof.nearest_join):
        whole = join(left, right, event_tie="unit_id", rows_per_slice=None)
        sliced = join(left, right, event_tie="unit_id", rows_per_slice=5)
        assert sorted(whole.collect(), key=lambda r: r.unit_id) == sorted(sliced.collect(), key=lambda r: r.unit_id)


def test_asof_against_brute_force(spark):
    rows, marks = random_streams()
    joined = asof.asof_join(
        spark.createDataFrame(rows, PROCESSING_EVENT),
        spark.createDataFrame(marks, READINGS),
        event_tie="unit_id",
        rows_per_slice=10,
    )
    got = {r.unit_id: r[1] for r in joined.select("unit_id", "reading.energy").collect()}
    for ts, line, station, unit, _ in rows:
        older = [(m[0], m[3]) for m in marks if m[1:3] == (line, station) and m[0] <= ts]
        assert got[unit] == (max(older)[1] if older else None)


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_equals_batch(spark, player, salts):
    rows, marks = random_streams(120)
    play = player(events=PROCESSING_EVENT, readings=READINGS)
    hour = "1 hour"
    play.start(
        joins.asof_join(
            windows.with_disorder(play.stream("events"), hour),
            windows.with_disorder(play.stream("readings"), hour),
            ["energy"],
            salts=salts,
        )
    )
    names = ["ts", "line", "station", "unit_id", "action"]
    for part in range(2):
        play.feed(
            events=[dict(zip(names, r)) for r in rows[part::2]],
            readings=[dict(zip(["ts", "line", "station", "energy"], m)) for m in marks[part::2]],
        )
    end = at("2025-01-30 15:00:00")
    out = play.feed(
        events=[dict(zip(names, (end, 99, 0, -1, "IN")))],
        readings=[{"ts": end, "line": 99, "station": 0, "energy": 0}],
    )
    batch = asof.asof_join(
        spark.createDataFrame(rows, PROCESSING_EVENT), spark.createDataFrame(marks, READINGS), event_tie="unit_id"
    ).select("unit_id", "reading.energy")
    assert {r.unit_id: r.energy for r in out} == {r.unit_id: r.energy for r in batch.collect()}


def test_energy_of_a_reading_map(spark):
    df = spark.range(1).select(
        F.create_map(F.lit(ENERGY_CONSUMPTION), reading(ENERGY_CONSUMPTION, F.lit(4.5), "kWh")).alias("readings")
    )
    assert df.select(energy("readings")).first()[0] == 4.5
