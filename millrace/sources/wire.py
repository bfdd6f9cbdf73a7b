"""The JSON form in which events travel: camel-case names, instants as decimal epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.records import decode_json

# Field names and types on the wire.
INSTANT = "DECIMAL(20,9)"
PROCESSING_EVENT_WIRE = f"timestamp {INSTANT}, line INT, station INT, unitId BIGINT, action STRING"
GENERIC_EVENT_WIRE = (
    f"id BIGINT, timestamp {INSTANT}, value STRING, firstName STRING, secondName STRING, country STRING, "
    "city STRING, occupation STRING"
)


def _to_instant(ts: Column) -> Column:
    return (F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000)).cast(INSTANT.lower())


def processing_events(parsed: DataFrame) -> DataFrame:
    """Columns of the data model from parsed wire columns."""
    return parsed.select(
        F.timestamp_seconds("timestamp").alias("ts"), "line", "station", F.col("unitId").alias("unit_id"), "action"
    )


def events_from_avro(record: DataFrame) -> DataFrame:
    """Columns of the data model from an Avro record's."""
    return record.select(F.col("timestamp").alias("ts"), "line", "station", F.col("unitId").alias("unit_id"), "action")


def events_to_avro(events: DataFrame) -> DataFrame:
    """An Avro record's columns from those of the data model."""
    return events.select(F.col("ts").alias("timestamp"), "line", "station", F.col("unit_id").alias("unitId"), "action")


def statistics_to_avro(statistics: DataFrame) -> DataFrame:
    """An Avro record's columns from window counts with timestamps."""
    return statistics.select(
        "line", F.col("window_start").alias("windowStart"), F.col("window_end").alias("windowEnd"), "count"
    )


def generic_events(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "id",
        F.timestamp_seconds("timestamp").alias("timestamp"),
        "value",
        F.col("firstName").alias("first_name"),
        F.col("secondName").alias("second_name"),
        "country",
        "city",
        "occupation",
    )


def decode_processing_events(messages: DataFrame, column: str = "value") -> DataFrame:
    return processing_events(decode_json(messages, PROCESSING_EVENT_WIRE, column))


def decode_generic_events(messages: DataFrame, column: str = "value") -> DataFrame:
    return generic_events(decode_json(messages, GENERIC_EVENT_WIRE, column))


def encode_processing_events(events: DataFrame) -> DataFrame:
    record = F.struct(
        _to_instant(F.col("ts")).alias("timestamp"), "line", "station", F.col("unit_id").alias("unitId"), "action"
    )
    return events.select(F.to_json(record).alias("value"))


def encode_generic_events(events: DataFrame) -> DataFrame:
    """Messages with the id as key, so that a topic keeps the order per id."""
    record = F.struct(
        "id",
        _to_instant(F.col("timestamp")).alias("timestamp"),
        "value",
        F.col("first_name").alias("firstName"),
        F.col("second_name").alias("secondName"),
        "country",
        "city",
        "occupation",
    )
    return events.select(F.col("id").cast("string").alias("key"), F.to_json(record).alias("value"))
