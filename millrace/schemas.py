"""Record layouts, stated once for every source and operator."""

from __future__ import annotations

# The two actions and the two sensor types of the data model.
IN, OUT = "IN", "OUT"
ENERGY_CONSUMPTION, TEMPERATURE = "ENERGY_CONSUMPTION", "TEMPERATURE"

PROCESSING_EVENT = "ts TIMESTAMP, line INT, station INT, unit_id BIGINT, action STRING"

READING = "STRUCT<type: STRING, value: DOUBLE, unit: STRING>"

STATION_PROCESSING_EVENT = (
    "line INT, station INT, unit_id BIGINT, start_ts TIMESTAMP, end_ts TIMESTAMP, energy_consumption DOUBLE"
)

UNIT_SUMMARY = "unit_id BIGINT, line BIGINT, energy_consumption DOUBLE"

STATISTICS = "line INT, window_start BIGINT, window_end BIGINT, count BIGINT"

INACTIVITY_ALERT = "line BIGINT, station BIGINT, timestamp BIGINT"

STATION_COUNT = "line INT, station INT, unit_count BIGINT"

STATION_REPORT = "line INT, station INT, unit_count BIGINT, min_duration_ms BIGINT, max_duration_ms BIGINT"

STATION_AVERAGE = f"{STATION_REPORT}, avg_duration_ms DOUBLE"

GENERIC_EVENT = (
    "id BIGINT, timestamp TIMESTAMP, value STRING, "
    "first_name STRING, second_name STRING, country STRING, city STRING, occupation STRING"
)

NESTED_EVENT = (
    "id BIGINT, long1 BIGINT, long2 BIGINT, string1 STRING, string2 STRING, string3 STRING, "
    "nested ARRAY<STRUCT<string1: STRING, string2: STRING, long1: BIGINT>>, bool1 BOOLEAN, bool2 BOOLEAN"
)

# The Avro records in which events and window counts travel, with their names on the wire.
PROCESSING_EVENT_AVRO = """{
  "type": "record", "name": "ProcessingEvent", "fields": [
    {"name": "timestamp", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "line", "type": "int"},
    {"name": "station", "type": "int"},
    {"name": "unitId", "type": "long"},
    {"name": "action", "type": {"type": "enum", "name": "Action", "symbols": ["IN", "OUT"]}}
  ]}"""

STATISTICS_AVRO_SCHEMA = """{
  "type": "record", "name": "Statistics", "fields": [
    {"name": "line", "type": "int"},
    {"name": "windowStart", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "windowEnd", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "count", "type": "long"}
  ]}"""

LINE_STATION = ["line", "station"]
VISIT = ["line", "station", "unit_id"]
