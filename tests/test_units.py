from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions.records import energy
from millrace.operators import pairing
from millrace.plans.energy import energy_per_unit
from millrace.schemas import PROCESSING_EVENT
from millrace.sources import generators
from millrace.streaming import units, windows
from tests.conftest import at

START = at("2026-01-30 12:00:01")
# Unit, then IN and OUT of stations 0 and 1 in seconds from the start.
UNITS = [(1, [(0, 30), (35, 65)]), (2, [(10, 20), (22, 28)])]
EXPECTED = {(1, 0): 600.0, (2, 0): 160.0}


def fixture_rows():
    rows = []
    for unit, visits in UNITS:
        for station, (go_in, go_out) in enumerate(visits):
            rows.append((START + timedelta(seconds=go_in), 0, station, unit, "IN"))
            rows.append((START + timedelta(seconds=go_out), 0, station, unit, "OUT"))
    return rows


def meter(spark, jitter=False):
    readings = generators.sensor_readings(spark, at("2026-01-30 12:00:00"), 120, jitter=jitter)
    return readings.select("ts", "line", "station", energy("readings").alias("energy"))


def with_id(events):
    return events.withColumn("event_id", F.unix_micros(F.col("ts").cast("timestamp")))


def test_energy_per_unit(spark):
    events = with_id(spark.createDataFrame(fixture_rows(), PROCESSING_EVENT))
    for rows_per_slice in (4_000_000, 1):
        got = energy_per_unit(events, meter(spark), 2, reading_tie=None, rows_per_slice=rows_per_slice)
        assert {(r.unit_id, r.line): r.energy_consumption for r in got.collect()} == EXPECTED


def test_energy_per_unit_with_jitter_is_close(spark):
    events = with_id(spark.createDataFrame(fixture_rows(), PROCESSING_EVENT))
    for row in energy_per_unit(events, meter(spark, jitter=True), 2, reading_tie=None).collect():
        # Each of the four differences is off by at most one reading and the noise of two.
        assert abs(row.energy_consumption - EXPECTED[(row.unit_id, row.line)]) <= 2 * (10 + 2)


def test_energy_per_unit_in_a_stream(spark, player):
    play = player(events=PROCESSING_EVENT, readings="ts TIMESTAMP, line INT, station INT, energy DOUBLE")
    play.start(windows.energy_per_unit(play.stream("events"), play.stream("readings"), 2))
    names = ["ts", "line", "station", "unit_id", "action"]
    marks = [r.asDict() for r in meter(spark).collect()]
    for part in range(2):
        play.feed(
            events=[dict(zip(names, r)) for r in sorted(fixture_rows())[part * 4 : part * 4 + 4]],
            readings=marks[part * 240 : part * 240 + 240],
        )
    end = at("2026-01-30 12:30:00")
    rows = play.feed(
        events=[dict(zip(names, (end, 99, 0, -1, "IN")))],
        readings=[{"ts": end, "line": 99, "station": 0, "energy": 0}],
    )
    assert {(r.unit_id, r.line): r.energy_consumption for r in rows} == EXPECTED


PAIRS = "event_id BIGINT, ts TIMESTAMP, line INT, station INT, unit_id BIGINT, action STRING, energy DOUBLE"


def visit(i, second, action, energy=None, unit=1):
    return (i, START + timedelta(seconds=second), 0, 0, unit, action, energy)


PAIR_CASES = [
    # start and end in either order of arrival
    ([visit(0, 0, "IN", 1.0), visit(1, 5, "OUT", 4.0)], [(0, 5, 3.0)]),
    ([visit(0, 5, "OUT", 4.0), visit(1, 0, "IN", 1.0)], [(0, 5, 3.0)]),
    # no partner, no row
    ([visit(0, 0, "IN", 1.0)], []),
    ([visit(0, 0, "IN"), visit(1, 3, "IN")], []),
    # a missing reading gives no energy
    ([visit(0, 0, "IN"), visit(1, 5, "OUT", 4.0)], [(0, 5, None)]),
    # a second visit starts afresh
    (
        [visit(0, 0, "IN", 1.0), visit(1, 5, "OUT", 4.0), visit(2, 8, "IN", 4.0), visit(3, 9, "OUT", 9.0)],
        [(0, 5, 3.0), (8, 9, 5.0)],
    ),
]


def seconds_of(rows):
    return sorted(
        ((r.start_ts - START).seconds, (r.end_ts - START).seconds, r.energy_consumption) for r in rows
    )


@pytest.mark.parametrize("rows, expected", PAIR_CASES)
def test_pairing(spark, rows, expected):
    events = spark.createDataFrame(rows, PAIRS)
    for rows_per_slice in (None, 1):
        got = pairing.pair_in_out(events, "energy", rows_per_slice=rows_per_slice).collect()
        assert seconds_of(got) == expected


def test_pairing_in_a_stream_row_by_row(player):
    """Every case is a unit of its own; one event of each per micro-batch."""
    play = player(events=PAIRS)
    play.start(units.pair_in_out(play.stream("events"), "energy"))
    names = [c.split()[0] for c in PAIRS.split(", ")]
    got = []
    for step in range(4):
        batch = [
            {**dict(zip(names, rows[step])), "unit_id": unit}
            for unit, (rows, _) in enumerate(PAIR_CASES)
            if step < len(rows)
        ]
        got = play.feed(events=[{k: v for k, v in row.items() if v is not None} for row in batch])
    for unit, (_, expected) in enumerate(PAIR_CASES):
        assert seconds_of(r for r in got if r.unit_id == unit) == expected


VISITS = "event_id BIGINT, line INT, unit_id BIGINT, end_ts TIMESTAMP, energy_consumption DOUBLE"


def visits():
    rng = random.Random(11)
    rows = []
    for i in range(200):
        unit = 0 if i % 3 == 0 else rng.randrange(1, 25)
        used = None if i % 7 == 0 else float(rng.randrange(50))
        rows.append((i, i % 4, unit, START + timedelta(seconds=i), used))
    return rows


def expected_sums(stations):
    sums, by_unit = [], {}
    for row in visits():
        by_unit.setdefault(row[2], []).append(row)
    for unit, rows in by_unit.items():
        for i in range(0, len(rows) - stations + 1, stations):
            chunk = rows[i : i + stations]
            sums.append((unit, chunk[-1][1], sum(r[4] or 0.0 for r in chunk)))
    return sorted(sums)


@pytest.mark.parametrize("rows_per_slice", [None, 4])
def test_sum_per_unit(spark, rows_per_slice):
    table = spark.createDataFrame(visits(), VISITS)
    got = pairing.sum_per_unit(table, 3, rows_per_slice=rows_per_slice).collect()
    assert sorted((r.unit_id, r.line, r.energy_consumption) for r in got) == expected_sums(3)


def test_sum_per_unit_in_a_stream(player):
    play = player(visits=VISITS)
    play.start(units.sum_per_unit(play.stream("visits"), 3))
    names = [c.split()[0] for c in VISITS.split(", ")]
    rows = [{k: v for k, v in zip(names, r) if v is not None} for r in visits()]
    got = []
    for part in range(0, 200, 70):
        got = play.feed(visits=rows[part : part + 70])
    assert sorted((r.unit_id, r.line, r.energy_consumption) for r in got) == expected_sums(3)


def test_an_orphan_is_forgotten(player):
    play = player(events=PAIRS)
    play.start(units.pair_in_out(windows.in_order(play.stream("events")), "energy", orphan_seconds=60))
    names = [c.split()[0] for c in PAIRS.split(", ")]

    def feed(*rows):
        return play.feed(events=[dict(zip(names, r)) for r in rows])

    feed(visit(0, 0, "IN", 1.0, unit=1), visit(1, 30, "IN", 1.0, unit=2))
    # Past the minute of the first unit, not past that of the second.
    feed(visit(2, 70, "IN", 1.0, unit=3))
    got = feed(visit(3, 75, "OUT", 4.0, unit=1), visit(4, 76, "OUT", 4.0, unit=2))
    assert [(r.unit_id, r.energy_consumption) for r in got] == [(2, 3.0)]
