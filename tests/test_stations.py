from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import counts, durations
from millrace.schemas import PROCESSING_EVENT
from millrace.streaming import micro, stations
from tests.conftest import at

START = at("2026-01-30 12:00:00")
EVENTS = "event_id BIGINT, " + PROCESSING_EVENT


def random_events(n=300):
    """Units wander between stations; a third of all events is at station (0, 0). Some INs and OUTs are missing."""
    rng = random.Random(2)
    rows = []
    for i in range(n):
        line, station = (0, 0) if i % 3 == 0 else (rng.randrange(2), rng.randrange(2))
        rows.append((i, START + timedelta(milliseconds=137 * i), line, station, rng.randrange(12), rng.choice(["IN", "OUT"])))
    return rows


def expected_reports(rows):
    """(event id, line, station, count, min, max, average) the way a unit's arrival is remembered and cleared."""
    inside, stats, out = {}, {}, []
    for i, ts, line, station, unit, action in sorted(rows, key=lambda r: (r[1], r[0])):
        visit = (line, station, unit)
        if action == "IN":
            inside[visit] = ts
        elif visit in inside:
            spent = round((ts - inside.pop(visit)) / timedelta(milliseconds=1))
            times = stats.setdefault((line, station), [])
            times.append(spent)
            out.append((i, line, station, len(times), min(times), max(times), sum(times) / len(times)))
    return sorted(out)


COLUMNS = ["line", "station", "unit_count", "min_duration_ms", "max_duration_ms", "avg_duration_ms"]


@pytest.mark.parametrize("rows_per_slice", [None, 6])
def test_station_report(spark, rows_per_slice):
    rows = random_events()
    report = durations.station_report(spark.createDataFrame(rows, EVENTS), rows_per_slice=rows_per_slice)
    assert sorted(tuple(r) for r in report.select("event_id", *COLUMNS).collect()) == expected_reports(rows)


@pytest.mark.parametrize("rows_per_slice", [None, 6])
def test_running_count(spark, rows_per_slice):
    rows = random_events()
    got = counts.running_station_count(spark.createDataFrame(rows, EVENTS), rows_per_slice=rows_per_slice).collect()
    seen, expected = {}, {}
    for i, _, line, station, _, action in rows:
        if action == "OUT":
            seen[(line, station)] = seen.get((line, station), 0) + 1
            expected[i] = seen[(line, station)]
    assert {r.event_id: r.unit_count for r in got} == expected


def feed_in_parts(play, rows, parts=3):
    names = [c.split()[0] for c in EVENTS.split(", ")]
    size = -(-len(rows) // parts)
    got = []
    for i in range(0, len(rows), size):
        got = play.feed(events=[dict(zip(names, r)) for r in rows[i : i + size]])
    return got


def test_station_report_in_a_stream(player):
    rows = random_events()
    play = player(events=EVENTS)
    play.start(stations.station_report(play.stream("events"), "event_id", average=True))
    got = sorted(tuple(r) for r in feed_in_parts(play, rows))
    assert got == sorted(e[1:] for e in expected_reports(rows))


def test_running_count_in_a_stream(player):
    rows = random_events()
    play = player(events=EVENTS)
    play.start(stations.running_station_count(play.stream("events")))
    got = sorted(tuple(r) for r in feed_in_parts(play, rows))
    totals = {}
    for _, _, line, station, _, action in rows:
        if action == "OUT":
            totals[(line, station)] = totals.get((line, station), 0) + 1
    assert got == sorted((*key, n) for key, total in totals.items() for n in range(1, total + 1))


def test_out_without_in_is_skipped(spark):
    rows = [(0, START, 0, 0, 1, "OUT"), (1, START + timedelta(seconds=1), 0, 0, 1, "IN")]
    assert durations.station_report(spark.createDataFrame(rows, EVENTS)).count() == 0


def test_a_second_in_replaces_the_first(spark):
    rows = [(i, START + timedelta(seconds=i), 0, 0, 1, a) for i, a in enumerate(["IN", "IN", "OUT", "OUT"])]
    got = durations.station_report(spark.createDataFrame(rows, EVENTS)).collect()
    assert [(r.event_id, r.min_duration_ms) for r in got] == [(2, 1000)]


def run_in_parts(play, step, tmp_path, rows, parts=3):
    """Feed the rows in parts and resume the query once in between."""
    folder = str(tmp_path / "figures")
    names = [c.split()[0] for c in EVENTS.split(", ")]
    size = -(-len(rows) // parts)
    for i in range(0, len(rows), size):
        play.query = micro.run(play.stream("events"), step, folder, play.checkpoint, available_now=False)
        play.table = "unused"
        play.spark.sql("CREATE OR REPLACE TEMP VIEW unused AS SELECT 1")
        play.feed(events=[dict(zip(names, r)) for r in rows[i : i + size]])
        play.query.stop()
    return micro.output(play.spark, folder)


def test_station_report_by_micro_batch(player, tmp_path):
    rows = random_events()
    play = player(events=EVENTS)
    got = run_in_parts(play, micro.station_report(rows_per_slice=6), tmp_path, rows)
    assert sorted(tuple(r) for r in got.select("event_id", *COLUMNS).collect()) == expected_reports(rows)


def test_running_count_by_micro_batch(spark, player, tmp_path):
    rows = random_events()
    play = player(events=EVENTS)
    got = run_in_parts(play, micro.running_station_count(rows_per_slice=6), tmp_path, rows)
    whole = counts.running_station_count(spark.createDataFrame(rows, EVENTS))
    names = ["event_id", "line", "station", "unit_count"]
    assert sorted(got.select(*names).collect()) == sorted(whole.select(*names).collect())
