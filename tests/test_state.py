"""State of a stopped query: read, moved into a new layout, resumed, extended."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.session import STATE_ENCODING, evolvable
from millrace.sources import files
from millrace.streaming import state, stations, windows
from tests.conftest import at, wire_line

START = at("2026-01-30 12:00:00")


def write(folder, name, steps):
    """Events of unit 1 as (second, line, station, action)."""
    folder.mkdir(exist_ok=True)
    lines = [wire_line(START + timedelta(seconds=s), line, station, 1, action) for s, line, station, action in steps]
    (folder / name).write_text("\n".join(lines))


def first_phase(spark, tmp_path):
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "counts")
    write(
        inbox,
        "input-file-1.txt",
        [(i, 0, i // 2 % 2, "IN" if i % 2 == 0 else "OUT") for i in range(8)],
    )
    counted = files.run_to_table(
        stations.running_station_count(files.watch_processing_events(spark, str(inbox))), checkpoint=checkpoint
    )
    return counted, checkpoint


SECOND = [(s, 0, station, action) for s, (station, action) in enumerate(
    [(0, "IN"), (0, "OUT"), (1, "IN"), (1, "OUT"), (0, "IN"), (0, "OUT"), (1, "IN")], start=20
)]


def test_counts_carry_over(spark, tmp_path):
    counted, checkpoint = first_phase(spark, tmp_path)
    assert sorted(tuple(r) for r in counted.collect()) == [(0, 0, 1), (0, 0, 2), (0, 1, 1), (0, 1, 2)]
    kept = state.station_counts(spark, checkpoint)
    assert sorted(tuple(r) for r in kept.collect()) == [(0, 0, 2), (0, 1, 2)]
    stats = state.as_station_stats(kept)
    assert sorted(tuple(r) for r in stats.collect()) == [(0, 0, 2, None, None), (0, 1, 2, None, None)]

    write(tmp_path / "second", "input-file-2.txt", SECOND)
    events = files.watch_processing_events(spark, str(tmp_path / "second"))
    report = files.run_to_table(state.resume_as_report(events, checkpoint)).collect()
    assert sorted((r.station, r.unit_count) for r in report) == [(0, 3), (0, 4), (1, 3)]
    assert all((r.min_duration_ms, r.max_duration_ms) == (1000, 1000) for r in report)


def test_a_unit_that_came_in_before_the_hand_over_is_skipped(spark, tmp_path):
    _, checkpoint = first_phase(spark, tmp_path)
    write(tmp_path / "second", "f.txt", [(20, 0, 0, "OUT"), (21, 0, 0, "IN"), (23, 0, 0, "OUT")])
    events = files.watch_processing_events(spark, str(tmp_path / "second"))
    report = files.run_to_table(state.resume_as_report(events, checkpoint)).collect()
    assert [tuple(r) for r in report] == [(0, 0, 3, 2000, 2000)]


def test_resume_with_an_added_average(spark, tmp_path):
    """The same checkpoint goes on with a new state variable; count, extremes and open visits are kept."""
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "report")
    write(inbox, "1.txt", [(0, 0, 0, "IN"), (4, 0, 0, "OUT"), (5, 0, 0, "IN")])
    first = files.run_to_table(
        stations.station_report(files.watch_processing_events(spark, str(inbox))), checkpoint=checkpoint
    )
    assert [tuple(r) for r in first.collect()] == [(0, 0, 1, 4000, 4000)]
    assert [(r.unit_id, r.line, r.station) for r in state.units_inside(spark, checkpoint).collect()] == [(1, 0, 0)]

    write(inbox, "2.txt", [(7, 0, 0, "OUT"), (8, 0, 0, "IN"), (14, 0, 0, "OUT")])
    second = files.run_to_table(
        stations.station_report(files.watch_processing_events(spark, str(inbox)), average=True), checkpoint=checkpoint
    )
    # The output of both runs; rows from before the upgrade have no average.
    assert sorted(tuple(r) for r in second.collect()) == [
        (0, 0, 1, 4000, 4000, None),
        (0, 0, 2, 2000, 4000, 2000.0),
        (0, 0, 3, 2000, 6000, 4000.0),
    ]
    stats = state.station_stats(spark, checkpoint).drop("partition_id").collect()
    assert [tuple(r) for r in stats] == [(0, 0, 3, 2000, 6000)]


def test_inventory(spark, tmp_path):
    _, checkpoint = first_phase(spark, tmp_path)
    listed = state.inventory(spark, checkpoint).collect()
    assert [(r.operatorId, r.numPartitions) for r in listed] == [(0, int(spark.conf.get("spark.sql.shuffle.partitions")))]
    assert listed[0].bytes > 0
    sizes = state.file_sizes(spark, checkpoint)
    assert sizes.where(F.col("operatorId") == 0).agg(F.sum("bytes")).first()[0] == listed[0].bytes
    by_partition = state.read_value_state(spark, checkpoint, stations.COUNT_STATE).groupBy("partition_id").count()
    assert sum(r["count"] for r in by_partition.collect()) == 2


def test_state_of_an_earlier_batch(spark, tmp_path):
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "c")
    for i in range(2):
        write(inbox, f"{i}.txt", [(i, 0, 0, "OUT")])
        files.run_to_table(
            stations.running_station_count(files.watch_processing_events(spark, str(inbox))), checkpoint=checkpoint
        )
    for batch in (0, 1):
        rows = state.read_value_state(spark, checkpoint, stations.COUNT_STATE, batch_id=batch).collect()
        assert [r.unit_count for r in rows] == [batch + 1]


def report(spark, inbox, checkpoint, **kind):
    events = files.watch_processing_events(spark, str(inbox))
    return files.run_to_table(stations.station_report(events, **kind), checkpoint=checkpoint)


def dumped(df):
    return sorted(tuple(r) for r in df.select("variable", "key", "entry", "value").collect())


def test_dump_of_all_variables(spark, tmp_path):
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "report")
    write(inbox, "1.txt", [(0, 0, 0, "IN"), (4, 0, 0, "OUT"), (5, 0, 0, "IN"), (6, 2, 1, "IN")])
    report(spark, inbox, checkpoint)
    kept = state.variables(spark, checkpoint).select("variable", "kind").collect()
    assert {tuple(r) for r in kept} == {("inProgress", "MapState"), ("stationStats", "ValueState")}
    arrived = 1_769_774_400_000
    inside = [
        ("inProgress", '{"line":0,"station":0}', '{"unit_id":1}', f'{{"arrival_ms":{arrived + 5000}}}'),
        ("inProgress", '{"line":2,"station":1}', '{"unit_id":1}', f'{{"arrival_ms":{arrived + 6000}}}'),
    ]
    stats = [("stationStats", '{"line":0,"station":0}', None, '{"unit_count":1,"min_duration_ms":4000,"max_duration_ms":4000}')]
    assert dumped(state.dump(spark, checkpoint)) == inside + stats

    write(inbox, "2.txt", [(7, 0, 0, "OUT")])
    report(spark, inbox, checkpoint)
    assert dumped(state.dump(spark, checkpoint, batch_id=0)) == inside + stats
    assert dumped(state.dump(spark, checkpoint))[0] == inside[1] and len(dumped(state.dump(spark, checkpoint))) == 2
    changed = state.changes(spark, checkpoint, first_batch=1)
    assert {(r.batch_id, r.change_type, r.variable) for r in changed.collect()} == {
        (1, "update", "stationStats"), (1, "delete", "inProgress")
    }


def test_dump_shows_fields_without_value(spark, tmp_path):
    _, checkpoint = first_phase(spark, tmp_path)
    write(tmp_path / "second", "f.txt", [(20, 0, 0, "IN")])
    events = files.watch_processing_events(spark, str(tmp_path / "second"))
    resumed = str(tmp_path / "resumed")
    files.run_to_table(state.resume_as_report(events, checkpoint), checkpoint=resumed)
    values = {r.value for r in state.dump(spark, resumed).where("variable = 'stationStats'").collect()}
    assert values == {'{"unit_count":2,"min_duration_ms":null,"max_duration_ms":null}'}


def test_dump_of_timers_joins_and_windows(spark, tmp_path):
    inbox = tmp_path / "in"
    write(inbox, "1.txt", [(0, 0, 0, "IN"), (400, 0, 0, "OUT"), (401, 0, 1, "IN")])
    events = files.watch_processing_events(spark, str(inbox))

    silent = str(tmp_path / "silent")
    files.run_to_table(stations.inactivity_buffered(windows.with_disorder(events), 60, 10), checkpoint=silent)
    kinds = {r.variable: r.kind for r in state.variables(spark, silent).collect()}
    assert kinds["lastSeen"] == "ValueState" and kinds[state.TIMERS] == "Timers"
    timers = [t for t in dumped(state.dump(spark, silent)) if t[0] == state.TIMERS]
    assert [t[1] for t in timers] == ['{"line":0,"station":0}', '{"line":0,"station":1}'] and all(int(t[3]) > 0 for t in timers)

    visits = str(tmp_path / "visits")
    files.run_to_table(windows.pair_in_out(events, "1 DAY"), checkpoint=visits)
    assert {r.variable for r in state.variables(spark, visits).collect()} == {"left", "right"}
    assert [t[0] for t in dumped(state.dump(spark, visits))] == ["left", "left", "right"]

    counted = str(tmp_path / "windows")
    files.run_to_table(windows.units_per_window(events, 1), checkpoint=counted)
    assert [(t[0], t[3]) for t in dumped(state.dump(spark, counted))] == [("state", '{"count":1}')]


def test_a_value_gets_more_fields(spark, tmp_path):
    """Of one variable; counts, extremes and open visits go on, the average begins with the first new time."""
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "report")
    write(inbox, "1.txt", [(0, 0, 0, "IN"), (4, 0, 0, "OUT"), (5, 0, 0, "IN")])
    with evolvable(spark):
        report(spark, inbox, checkpoint)
        write(inbox, "2.txt", [(7, 0, 0, "OUT"), (8, 0, 0, "IN"), (14, 0, 0, "OUT"), (15, 0, 1, "IN"), (16, 0, 1, "OUT")])
        second = report(spark, inbox, checkpoint, evolved=True)
    assert spark.conf.get(STATE_ENCODING) == "unsaferow"
    assert sorted(tuple(r) for r in second.collect()) == [
        (0, 0, 1, 4000, 4000, None), (0, 0, 2, 2000, 4000, 2000.0), (0, 0, 3, 2000, 6000, 4000.0), (0, 1, 1, 1000, 1000, 1000.0)
    ]
    stats = state.read_value_state(spark, checkpoint, stations.STATS_STATE).drop("partition_id").collect()
    assert sorted(tuple(r) for r in stats) == [(0, 0, 3, 2000, 6000, 2, 8000), (0, 1, 1, 1000, 1000, 1, 1000)]


def test_without_the_encoding_more_fields_are_refused(spark, tmp_path):
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "report")
    write(inbox, "1.txt", [(0, 0, 0, "IN"), (4, 0, 0, "OUT")])
    report(spark, inbox, checkpoint)
    write(inbox, "2.txt", [(5, 0, 0, "IN"), (6, 0, 0, "OUT")])
    with pytest.raises(StreamingQueryException):
        report(spark, inbox, checkpoint, evolved=True)


def test_evolved_report_continues_counts(spark, tmp_path):
    _, checkpoint = first_phase(spark, tmp_path)
    write(tmp_path / "second", "f.txt", SECOND)
    events = files.watch_processing_events(spark, str(tmp_path / "second"))
    counts = state.station_counts(spark, checkpoint)
    got = files.run_to_table(stations.station_report(events, initial_counts=state.as_station_stats(counts), evolved=True))
    assert sorted((r.station, r.unit_count, r.avg_duration_ms) for r in got.collect()) == [(0, 3, 1000.0), (0, 4, 1000.0), (1, 3, 1000.0)]
