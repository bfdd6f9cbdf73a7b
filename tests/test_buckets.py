"""Rows held in time buckets: what is read and written, and joins cut into any micro-batches."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from millrace.operators import asof, inactivity
from millrace.schemas import PROCESSING_EVENT
from millrace.sources import files
from millrace.streaming import joins, stations, windows
from millrace.streaming.buckets import Buckets
from tests.conftest import at
from tests.test_joins import READINGS, random_streams


class Held:
    """State variables in a dictionary that count what is done to them."""

    def __init__(self) -> None:
        self.values, self.calls = {}, 0

    def getMapState(self, name, key, value):
        return self

    def getValueState(self, name, fields):
        return Value()

    def updateValue(self, key, value):
        self.calls += 1
        self.values[key] = value

    def getValue(self, key):
        self.calls += 1
        return self.values[key]

    def removeKey(self, key):
        self.calls += 1
        del self.values[key]


class Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def frame(*us):
    return pd.DataFrame({"us": us, "name": [f"n{t}" for t in us]})


def test_rows_come_back_in_time_order():
    rng = random.Random(1)
    held = Buckets(Held(), "x", "us BIGINT, name STRING", 10)
    waiting, reached = [], 0
    for _ in range(200):
        new = [reached + rng.randint(1, 60) for _ in range(rng.randint(0, 5))]
        held.load()
        held.add(frame(*new))
        waiting += new
        reached += rng.randint(0, 12)
        got = [t for rows in held.take(reached) for t in sorted(rows["us"])]
        assert got == sorted(t for t in waiting if t <= reached)
        waiting = [t for t in waiting if t > reached]
        assert held.first() == min(waiting, default=None)
        for _ in range(3):
            edge = reached + rng.randint(0, 60)
            assert held.latest(edge) == max((t for t in waiting if t <= edge), default=None)
            after = [t for t in waiting if t > edge]
            ahead = held.next(edge)
            assert (ahead is None) == (not after) and (ahead is None or edge < ahead <= min(after))
            to = edge + rng.randint(0, 20)
            near = set(held.around(edge, to)["us"])
            wanted = {t for t in waiting if edge <= t <= to}
            wanted |= {max((t for t in waiting if t <= edge), default=None), min((t for t in waiting if t > to), default=None)}
            assert wanted - {None} <= near
        held.save()


def test_cost_does_not_depend_on_what_waits():
    def calls(waiting):
        state = Held()
        held = Buckets(state, "x", "us BIGINT, name STRING", 10)
        held.load()
        held.add(frame(*range(1000, 1000 + 10 * waiting, 3)))
        before = state.calls
        for t in range(0, 500, 5):
            held.add(frame(t, t + 1))
            list(held.take(t))
            held.forget(t)
        return state.calls - before

    assert calls(2) == calls(2000)


def test_forgets_all_but_the_newest():
    held = Buckets(Held(), "x", "us BIGINT, name STRING", 10)
    held.load()
    held.add(frame(1, 15, 31, 38, 52))
    held.forget(35)
    assert sorted(held.around(-100, 100)["us"]) == [31, 38, 52]
    assert sorted(held.entries.values) == [(3, 2), (5, 3)]


def feeds(rows, marks, parts):
    """Both streams in time order, cut into ``parts``."""
    names, marked = ["ts", "line", "station", "unit_id", "action"], ["ts", "line", "station", "energy"]
    rows, marks = sorted(rows), sorted(marks)
    edges = [max(rows[-1][0], marks[-1][0])] if parts == 1 else [rows[len(rows) * (i + 1) // parts - 1][0] for i in range(parts)]
    edges[-1] = at("2025-01-30 14:00:00")
    low = at("2025-01-30 00:00:00")
    for high in edges:
        yield {
            "events": [dict(zip(names, r)) for r in rows if low < r[0] <= high],
            "readings": [dict(zip(marked, m)) for m in marks if low < m[0] <= high],
        }
        low = high
    end = at("2025-01-30 20:00:00")
    yield {
        "events": [dict(zip(names, (end, 99, 0, -1, "IN")))],
        "readings": [{"ts": end, "line": 99, "station": 0, "energy": 0}],
    }


@pytest.mark.parametrize("parts", [1, 4, 10])
def test_nearest_join_does_not_depend_on_the_cut(spark, player, parts):
    rows, marks = random_streams(90)
    marks = [m for m in marks if m[0].minute % 10 < 4 and m[1:3] != (1, 2)]  # gaps, and a station without readings
    play = player(events=PROCESSING_EVENT, readings=READINGS)
    sides = [windows.with_disorder(play.stream(name)) for name in ("events", "readings")]
    play.start(joins.nearest_join(*sides, ["energy"], certain=True, salts=2, bucket_seconds=600))
    for part in feeds(rows, marks, parts):
        out = play.feed(**part)
    batch = asof.nearest_join(
        spark.createDataFrame(rows, PROCESSING_EVENT), spark.createDataFrame(marks, READINGS), event_tie="unit_id"
    ).select("unit_id", "reading.energy", "time_delta_ms")
    assert sorted((r.unit_id, r.energy, r.time_delta_ms) for r in out) == sorted(map(tuple, batch.collect()))


def test_nearest_join_waits_until_the_answer_is_certain(player):
    play = player(events=PROCESSING_EVENT, readings=READINGS)
    sides = [windows.in_order(play.stream(name)) for name in ("events", "readings")]
    play.start(joins.nearest_join(*sides, ["energy"], certain=True))
    event = {"line": 1, "station": 1, "unit_id": 1, "action": "IN"}

    def reach(second):
        ts = at(f"2025-01-30 12:00:{second:02d}")
        return play.feed(events=[{**event, "ts": ts, "line": 99}], readings=[{"ts": ts, "line": 99, "station": 1, "energy": 0}])

    play.feed(
        events=[{**event, "ts": at("2025-01-30 12:00:10")}],
        readings=[{"ts": at("2025-01-30 12:00:04"), "line": 1, "station": 1, "energy": 4}],
    )
    assert [r for r in reach(15) if r.line == 1] == []  # a reading at 12:00:15.5 would be nearer
    assert [(r.energy, r.time_delta_ms) for r in reach(16) if r.line == 1] == [(4.0, 6000)]


def test_buffered_inactivity_in_small_buckets(spark, player):
    rng = random.Random(3)
    start = at("2026-01-30 12:00:00")
    times = sorted(start.replace(hour=12 + rng.randrange(3), minute=rng.randrange(60), second=rng.randrange(60)) for _ in range(60))
    rows = [(t, i % 2, 1, i, "IN") for i, t in enumerate(times)]
    play = player(events=PROCESSING_EVENT)
    play.start(stations.inactivity_buffered(windows.with_disorder(play.stream("events")), 300, bucket_seconds=90))
    names = ["ts", "line", "station", "unit_id", "action"]
    for begin in range(0, 60, 15):
        play.feed(events=[dict(zip(names, r)) for r in rows[begin : begin + 15]])
    end = start.replace(hour=20)
    out = play.feed(events=[dict(zip(names, (end, 99, 1, -1, "IN")))])
    events = spark.createDataFrame(rows, PROCESSING_EVENT).selectExpr("* except (ts)", "cast(ts as timestamp_ntz) as ts", "unit_id as event_id")
    batch = inactivity.inactivity_buffered(events, 300, end)
    assert sorted(map(tuple, out)) == sorted(map(tuple, batch.collect()))


def test_visits_are_a_stream_stream_join(spark, player):
    play = player(events=PROCESSING_EVENT)
    play.start(windows.pair_in_out(play.stream("events"), "1 HOUR"))

    def event(unit, action, time):
        return {"ts": at("2025-01-30 " + time), "line": 1, "station": 1, "unit_id": unit, "action": action}

    play.feed(events=[event(1, "IN", "12:00:00"), event(2, "OUT", "12:05:00"), event(4, "IN", "12:00:00")])
    rows = play.feed(events=[event(1, "OUT", "12:10:00"), event(2, "IN", "12:04:58"), event(3, "IN", "12:10:00"), event(4, "OUT", "13:00:01")])
    assert sorted((r.unit_id, (r.end_ts - r.start_ts).seconds) for r in rows) == [(1, 600), (2, 2)]
    plan = play.query._jsq.explainInternal(False)
    assert "StreamingSymmetricHashJoin" in plan and "Python" not in plan


def test_a_loss_is_seen_however_many_reports_follow(spark, tmp_path):
    """One row behind the watermark, then more micro-batches than the query remembers reports of."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        folder = str(tmp_path / "in")
        schema = "ts TIMESTAMP, line INT, station INT, unit_id BIGINT, action STRING"
        spark.createDataFrame([], schema).write.json(folder)

        def feed(time):
            row = spark.createDataFrame([(at("2025-01-30 " + time), 1, 1, 1, "OUT")], schema)
            return lambda: row.write.mode("append").json(folder)

        stream = windows.units_per_window(spark.readStream.schema(schema).json(folder), 2)
        times = ["12:00:00", "14:00:00", "12:30:00", *[f"14:{m:02d}:00" for m in range(1, 8)]]
        result, lost = files.run_fed(stream, map(feed, times))
        assert lost == 1 and result.count() == 2
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_an_entry_is_one_value_and_keeps_nulls():
    state = Held()
    held = Buckets(state, "x", "us BIGINT, tie BIGINT, name STRING, value DOUBLE", 10)
    held.load()
    held.add(pd.DataFrame({"us": [3, 1], "tie": [2**60 + 1, 5], "name": [None, "a"], "value": [float("nan"), 0.5]}))
    held.add(pd.DataFrame({"us": [2], "tie": [7], "name": [None], "value": [None]}))
    assert all(isinstance(value, tuple) and [type(v) for v in value] == [bytes] for value in state.values.values())
    (got,) = held.take(9)
    got = got.sort_values("us")
    assert got["us"].tolist() == [1, 2, 3] and got["tie"].tolist() == [5, 7, 2**60 + 1]
    assert got["name"].isna().tolist() == [False, True, True]
    assert got["value"].isna().tolist() == [False, True, True]


def test_state_has_no_more_partitions_than_asked_for(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), tmp_path / "checkpoint"
    spark.range(9).write.parquet(folder)
    distinct = spark.readStream.schema("id BIGINT").parquet(folder).dropDuplicates(["id"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    result, _ = files.run_fed(distinct, [], str(checkpoint), partitions=1)
    assert result.count() == 9
    assert sorted(p.name for p in (checkpoint / "state" / "0").iterdir() if p.name.isdigit()) == ["0"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before == "2"
