from __future__ import annotations

import time
from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.functions.records import energy
from millrace.schemas import GENERIC_EVENT, PROCESSING_EVENT, STATISTICS
from millrace.session import fresh_path, shared_folder
from millrace.sources import files, generators, kafka, wire
from tests.conftest import at, wire_line

START = at("2026-01-30 12:00:00").replace(tzinfo=timezone.utc)


def test_monitored_folder_reads_new_files(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    ts = at("2026-01-30 12:00:00.250")
    (inbox / "1.txt").write_text(wire_line(ts, 0, 1, 7, "IN"))
    stream = files.watch_processing_events(spark, str(inbox), max_files=1)
    assert stream.isStreaming and stream.columns == [c.split()[0] for c in PROCESSING_EVENT.split(", ")]
    checkpoint = str(tmp_path / "checkpoint")
    first = files.run_to_table(stream, out, checkpoint)
    assert [tuple(r) for r in first.collect()] == [(ts, 0, 1, 7, "IN")]
    (inbox / "2.txt").write_text(wire_line(ts, 0, 1, 7, "OUT"))
    second = files.run_to_table(files.watch_processing_events(spark, str(inbox), max_files=1), out, checkpoint)
    assert sorted(r.action for r in second.collect()) == ["IN", "OUT"]


def test_wire_round_trip(spark):
    events = files.from_rows(spark, [(at("2026-01-30 12:00:00.123456"), 1, 2, 3, "OUT")], PROCESSING_EVENT)
    encoded = wire.encode_processing_events(events)
    assert '"unitId":3' in encoded.first().value
    assert wire.decode_processing_events(encoded).collect() == events.collect()


def test_generic_events_keep_their_key(spark):
    events = generators.generic_events(generators.indexed(spark, 4, START, 10))
    messages = wire.encode_generic_events(events)
    assert [r.key for r in messages.collect()] == ["0", "1", "2", "3"]
    assert wire.decode_generic_events(messages).collect() == events.collect()


def test_messages_pass_from_stream_to_stream_unchanged(spark, tmp_path):
    """What runs between two topics, between two folders here."""
    messages = wire.encode_generic_events(generators.generic_events(generators.indexed(spark, 20, START, 10)))
    messages.select("value").write.text(str(tmp_path / "in"))
    stream = spark.readStream.text(str(tmp_path / "in"))
    copied = files.run_to_table(wire.encode_generic_events(wire.decode_generic_events(stream)), str(tmp_path / "out"))
    assert sorted(copied.collect()) == sorted(messages.collect())


def test_processing_event_generator(spark):
    got = generators.processing_events(generators.indexed(spark, 24, START, 10)).collect()
    for i, row in enumerate(got):
        unit = i // 2
        own = at("2026-01-30 12:00:00") + timedelta(milliseconds=100 * i)
        late = timedelta(milliseconds=(unit % 5 + 1) * 100)
        assert row.unit_id == unit and (row.line, row.station) == (unit % 3, unit % 4)
        assert (row.action, row.ts) == (("IN", own) if i % 2 == 0 else ("OUT", own + late))
    small = generators.processing_events(generators.indexed(spark, 24, START, 10), 2, 2)
    assert {(r.line, r.station) for r in small.collect()} == {(0, 0), (1, 1)}


def test_generic_event_generator(spark):
    got = generators.generic_events(generators.indexed(spark, 50, START, 5)).collect()
    assert [f"{c.split()[0]}" for c in GENERIC_EVENT.split(", ")] == list(got[0].asDict())
    for i, row in enumerate(got):
        assert (row.id, row.value) == (i, f"value{i}")
        assert [len(row[c]) for c in ("first_name", "second_name", "country", "city", "occupation")] == [8, 12, 2, 20, 10]
    assert len({r.city for r in got}) == 50


def test_sensor_generator(spark):
    exact = generators.sensor_readings(spark, START, 3, jitter=False).select("ts", "line", "station", energy("readings"))
    rows = exact.collect()
    assert len(rows) == 12
    assert {(r.line, r.station) for r in rows} == {(a, b) for a in (0, 1) for b in (0, 1)}
    assert all(r[3] == 10.0 * (r.ts - at("2026-01-30 12:00:00")).seconds for r in rows)
    shaken = generators.sensor_readings(spark, START, 100).select("ts", energy("readings").alias("e")).collect()
    for i, row in enumerate(shaken):
        off = row.ts - (at("2026-01-30 12:00:00") + timedelta(seconds=i // 4))
        assert timedelta(milliseconds=-10) <= off < timedelta(milliseconds=10)
        assert abs(row.e - 10.0 * (i // 4)) <= 1


def test_paced_generator_streams(spark, tmp_path):
    stream = generators.processing_events(generators.paced(spark, 20, 1))
    assert stream.isStreaming
    query = files.to_memory(stream, "paced_events", str(tmp_path / "c"))
    try:
        deadline = time.time() + 60
        while spark.table("paced_events").count() < 4 and time.time() < deadline:
            time.sleep(0.5)
        rows = spark.table("paced_events").collect()
        assert len(rows) >= 4 and {r.action for r in rows} == {"IN", "OUT"}
    finally:
        query.stop()


@pytest.mark.parametrize("sink", [files.to_console, files.to_nowhere])
def test_console_and_discarding_sinks(spark, tmp_path, sink):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "1.txt").write_text(wire_line(at("2026-01-30 12:00:00"), 0, 1, 7, "IN"))
    query = sink(files.watch_processing_events(spark, str(inbox)), str(tmp_path / "c"))
    try:
        query.processAllAvailable()
        assert query.recentProgress[0]["numInputRows"] == 1
    finally:
        query.stop()


def test_topic_options():
    assert kafka.source_options("a:9092", "events") == {
        "kafka.bootstrap.servers": "a:9092",
        "subscribe": "events",
        "startingOffsets": "latest",
    }
    options = kafka.source_options("a:9092", "events", "earliest", 500, "group")
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "500" and options["kafka.group.id"] == "group"


def _has(spark, source: str) -> bool:
    try:
        spark.read.format(source).schema("value BINARY").load("/nowhere")
        return True
    except Exception as error:  # noqa: BLE001
        return "DATA_SOURCE_NOT_FOUND" not in str(error) and "Failed to find data source" not in str(error)


def test_avro_names_on_the_wire(spark):
    import json

    from millrace.schemas import PROCESSING_EVENT_AVRO, STATISTICS_AVRO_SCHEMA
    from millrace.sources import wire

    names = lambda schema: [f["name"] for f in json.loads(schema)["fields"]]
    counts = spark.createDataFrame([], "line INT, window_start TIMESTAMP, window_end TIMESTAMP, count BIGINT")
    assert wire.statistics_to_avro(counts).columns == names(STATISTICS_AVRO_SCHEMA)
    records = spark.createDataFrame([], "timestamp TIMESTAMP, line INT, station INT, unitId BIGINT, action STRING")
    assert records.columns == names(PROCESSING_EVENT_AVRO)
    assert wire.events_from_avro(records).columns == ["ts", "line", "station", "unit_id", "action"]


def test_avro_round_trip(spark):
    rows = files.from_rows(spark, [(1, 2, 3, 4)], STATISTICS).select(
        "line",
        F.timestamp_millis("window_start").alias("window_start"),
        F.timestamp_millis("window_end").alias("window_end"),
        "count",
    )
    assert [bytes(r.value) for r in kafka.encode_avro(rows, 258).collect()] == [bytes([0, 0, 0, 1, 2, 2, 4, 6, 8])]


def test_topics(spark):
    if not _has(spark, "kafka"):
        pytest.skip("the Kafka connector is not on this machine")
    assert kafka.read_topic(spark, "localhost:9", "events").isStreaming


def test_paths_lie_in_the_shared_folder(spark):
    path = fresh_path(spark, "x")
    assert path.startswith(shared_folder(spark)) and path != fresh_path(spark, "x")
