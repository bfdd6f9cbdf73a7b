"""Factory streams seen in the ``events`` table: line events, station events and a sensor meter.

Every view is an expression over the whole table, so it grows with it. ``ts`` stays TIMESTAMP_NTZ as stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.slices import find_cuts, running_sum, scan
from millrace.schemas import ENERGY_CONSUMPTION, IN, LINE_STATION, OUT, TEMPERATURE

LINE_STATIONS = 2
# The generator's numbers of lines and stations.
GENERATOR_LINES, GENERATOR_STATIONS = 3, 4


# Layouts of the tables read, so that no file has to be opened to plan a query.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def as_line_events(events: DataFrame) -> DataFrame:
    """Every unit passes two stations: IN and OUT at station 0, then at station 1."""
    return events.selectExpr(
        "event_id",
        "ts",
        "CAST((event_id DIV 4) % 3 AS INT) AS line",
        "CAST((event_id % 4) DIV 2 AS INT) AS station",
        "event_id DIV 4 AS unit_id",
        f"IF(event_id % 2 = 0, '{IN}', '{OUT}') AS action",
    )


def as_station_events(events: DataFrame) -> DataFrame:
    """Every unit visits one station."""
    return events.selectExpr(
        "event_id",
        "ts",
        f"CAST((event_id DIV 2) % {GENERATOR_LINES} AS INT) AS line",
        f"CAST((event_id DIV 2) % {GENERATOR_STATIONS} AS INT) AS station",
        "event_id DIV 2 AS unit_id",
        f"IF(event_id % 2 = 0, '{IN}', '{OUT}') AS action",
    )


def as_visitor_events(events: DataFrame) -> DataFrame:
    """Activity of 3 lines x 4 stations, spread by user."""
    return events.selectExpr(
        "event_id",
        "ts",
        "CAST(user_id % 3 AS INT) AS line",
        "CAST((user_id DIV 3) % 4 AS INT) AS station",
        "user_id AS unit_id",
        f"IF(event_id % 2 = 0, '{IN}', '{OUT}') AS action",
    )


# Readings of 3 lines x 2 stations.
_READING = [
    "event_id AS reading_id",
    "ts",
    "CAST(user_id % 3 AS INT) AS line",
    "CAST((user_id DIV 3) % 2 AS INT) AS station",
]


def as_readings(events: DataFrame) -> DataFrame:
    """Sensor readings as they are reported: energy and temperature of one instant."""
    return events.selectExpr(
        *_READING,
        f"""map('{ENERGY_CONSUMPTION}', named_struct('type', '{ENERGY_CONSUMPTION}', 'value', value, 'unit', 'kWh'),
                '{TEMPERATURE}', named_struct('type', '{TEMPERATURE}', 'value', value / 10, 'unit', 'C')) AS readings""",
    )


def as_meter(events: DataFrame) -> DataFrame:
    """The energy of the readings summed up per station, as a meter that only rises."""
    amounts = events.selectExpr(*_READING, "value")
    order = ["ts", "reading_id"]
    cuts = find_cuts(amounts, LINE_STATION, order)
    return scan(amounts, LINE_STATION, order, [running_sum("energy", F.col("value"))], cuts).drop("value")


def delayed(events: DataFrame) -> DataFrame:
    """The same rows in the same arrival order, some with a time 5 or 20 minutes earlier than when they arrive."""
    delay = "CASE event_id % 7 WHEN 3 THEN INTERVAL '20' MINUTE WHEN 5 THEN INTERVAL '5' MINUTE ELSE INTERVAL '0' MINUTE END"
    return events.withColumn("ts", F.expr(f"ts - {delay}"))


def as_measured_visits(events: DataFrame) -> DataFrame:
    """Every event as a visit of the unit ``user_id``; the energy is missing where the event is an error."""
    return events.selectExpr(
        "event_id",
        "CAST(event_id % 3 AS INT) AS line",
        "user_id AS unit_id",
        "ts AS end_ts",
        "IF(event_type <> 'error', value, NULL) AS energy_consumption",
    )


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_line_events(table(spark, sf_dir, "events"))


def station_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_station_events(table(spark, sf_dir, "events"))


def visitor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_visitor_events(table(spark, sf_dir, "events"))


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_meter(table(spark, sf_dir, "events"))
