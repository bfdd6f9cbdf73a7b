"""Stream results don't depend on how the input is cut into micro-batches."""

from __future__ import annotations

import os
from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from millrace.plans import catalog, streams
from millrace.sources import files
from millrace.streaming import micro
from tests.conftest import SF_DIR, at

STREAMS = [n for n in catalog.QUERIES if n.startswith("stream_")]


def cut(folder, parts, reverse=False):
    """The events in time order as several files, each newer than the one before it."""
    table = pq.read_table(f"{SF_DIR}/events.parquet").sort_by([("ts", "ascending"), ("event_id", "ascending")])
    target = folder / "events.parquet"
    target.mkdir(parents=True)
    size = -(-table.num_rows // parts)
    pieces = [table.slice(i, size) for i in range(0, table.num_rows, size)]
    for i, piece in enumerate(reversed(pieces) if reverse else pieces):
        name = target / f"part-{i}.parquet"
        pq.write_table(piece, name)
        os.utime(name, (1_700_000_000 + 10 * i,) * 2)
    return str(folder)


@pytest.fixture
def one_file_per_batch(monkeypatch):
    whole = files.watch_parquet
    monkeypatch.setattr(streams, "watch_parquet", lambda spark, path, schema: whole(spark, path, schema, max_files=1))


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("name", STREAMS)
def test_files_in_order(spark, tmp_path, one_file_per_batch, name):
    query = catalog.QUERIES[name]
    assert rows(query(spark, cut(tmp_path / "many", 4))) == rows(query(spark, SF_DIR))


@pytest.mark.parametrize("name", ["stream_asof_join", "stream_units_per_window", "stream_inactivity_buffered", "stream_sum_per_unit"])
def test_files_out_of_order_fail(spark, tmp_path, one_file_per_batch, name):
    with pytest.raises((StreamingQueryException, files.DroppedRows)):
        catalog.QUERIES[name](spark, cut(tmp_path / "many", 4, reverse=True)).collect()


EVENTS = "event_id BIGINT, ts TIMESTAMP, line INT, station INT, big BIGINT, part BIGINT"
READINGS = "reading_id BIGINT, ts TIMESTAMP, line INT, station INT, energy DOUBLE, counter BIGINT"


def fed(spark, tmp_path, step, batches, **options):
    """Output after the given micro-batches of (events, readings) and the end of the input."""
    folder, target = str(tmp_path / "out"), tmp_path / "in"
    target.mkdir()
    sides = [spark.createDataFrame([], s) for s in (EVENTS, READINGS)]
    schema = micro.united(*sides).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(target))
    for i, (events, readings) in enumerate(batches):
        whole = micro.united(spark.createDataFrame(events, EVENTS), spark.createDataFrame(readings, READINGS))
        whole.coalesce(1).write.mode("append").parquet(str(target))
    names = sorted(target.glob("part-*"), key=lambda p: p.stat().st_mtime_ns)
    for i, name in enumerate(names):
        os.utime(name, (1_700_000_000 + 10 * i,) * 2)
    return micro.to_table(stream, step, folder, **options), folder


T0 = at("2026-01-30 12:00:00")


def sec(n):
    return T0 + timedelta(seconds=n)


def test_columns_of_both_sides_keep_their_values(spark, tmp_path):
    huge = 2**53 + 1
    events = [(i, sec(i), 0, 0, huge + i, 3 if i % 2 else None) for i in range(10)]
    readings = [(i, sec(i), 0, 0, None if i % 3 else 1.5, huge - i) for i in range(0, 10, 2)]
    halves = [(events[:5], readings[:3]), (events[5:], readings[3:])]
    got, _ = fed(spark, tmp_path, micro.asof_join("reading_id"), halves, disorder_seconds=2)
    for r in got.collect():
        assert r["big"] == huge + r["event_id"] and r["part"] == (3 if r["event_id"] % 2 else None)
        assert r["reading"]["counter"] == huge - r["event_id"] // 2 * 2
    assert got.count() == 10


@pytest.mark.parametrize("cuts", [[10], [3, 7], [1, 2, 3, 4, 5, 6, 7, 8, 9]])
def test_nearest_does_not_depend_on_the_cut(spark, tmp_path, cuts):
    times = [0, 4, 5, 11, 12, 20, 21, 33, 34, 60]
    events = [(i, sec(t), 0, i % 2, i, None) for i, t in enumerate(times)]
    readings = [(i, sec(t), 0, 0, float(t), i) for i, t in enumerate([2, 8, 10, 30, 50, 58])]
    edges = [0, *[times[c - 1] + 1 for c in cuts], 1000]
    batches = [
        ([e for e in events if sec(a) <= e[1] < sec(b)], [r for r in readings if sec(a) <= r[1] < sec(b)])
        for a, b in zip(edges, edges[1:], strict=False)
    ]
    got, _ = fed(spark, tmp_path, micro.nearest_join("reading_id"), batches)
    want = {}
    for i, t in enumerate(times):
        if i % 2 == 0:
            want[i] = min((r[4] for r in readings), key=lambda e: (abs(e - t), e))
    assert {r["event_id"]: r["reading"]["energy"] for r in got.collect()} == want


def test_late_rows_within_the_grace_period_take_part(spark, tmp_path):
    on_time = ([(1, sec(100), 0, 0, 1, 1)], [(1, sec(10), 0, 0, 1.0, 1), (2, sec(50), 0, 0, 2.0, 2), (3, sec(99), 0, 0, 3.0, 3)])
    late = ([(2, sec(60), 0, 0, 1, 1), (3, sec(20), 0, 0, 1, 1), (4, sec(101), 0, 0, 1, 1)], [])
    step = micro.asof_join("reading_id", grace_seconds=50)
    got, folder = fed(spark, tmp_path, step, [on_time, late], grace_seconds=50)
    assert {r["event_id"]: r["reading"]["reading_id"] for r in got.collect()} == {1: 3, 2: 2, 4: 3}
    assert micro.dropped(spark, folder) == 1


def test_an_alert_comes_once(spark, tmp_path):
    step = micro.silences(10, equal_gap_alerts=True)
    times = [0, 3, 30, 31, 41, 90]
    batches = [([(i, sec(t), 0, 0, 0, 0)], []) for i, t in enumerate(times)]
    flat = micro.Step(step.tables, lambda r, b, u: step.apply(r.select("event.*"), b, u))
    got, folder = fed(spark, tmp_path, flat, batches, disorder_seconds=20)
    want = [t for t, following in zip(times, [*times[1:], 10**6], strict=True) if following - t >= 10]
    assert sorted(r["timestamp"] for r in got.collect()) == [int((sec(t) - at("1970-01-01 00:00:00")) / timedelta(milliseconds=1)) for t in want]


def test_no_input(spark, tmp_path):
    pq.write_table(pq.read_table(f"{SF_DIR}/events.parquet").slice(0, 0), (tmp_path / "events.parquet"))
    for name in ("stream_asof_join", "stream_running_station_count", "stream_units_per_window"):
        assert catalog.QUERIES[name](spark, str(tmp_path)).count() == 0
