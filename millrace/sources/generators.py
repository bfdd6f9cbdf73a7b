"""Event generators: the same column expressions over a range (batch) or a rate source (stream)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.records import reading
from millrace.schemas import ENERGY_CONSUMPTION, IN, OUT


def div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def indexed(spark: SparkSession, count: int, start: datetime, per_second: float) -> DataFrame:
    """``value`` 0..count-1 and a ``timestamp`` at an even rate."""
    micros = int(start.timestamp() * 1_000_000)
    return spark.range(count).select(
        F.col("id").alias("value"),
        F.timestamp_micros(F.lit(micros) + (F.col("id") * F.lit(1_000_000 / per_second)).cast("bigint")).alias(
            "timestamp"
        ),
    )


def paced(spark: SparkSession, per_second: int, partitions: int | None = None) -> DataFrame:
    """The same two columns as an endless stream."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", per_second)
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return reader.load()


def processing_events(index: DataFrame, lines: int = 3, stations: int = 4) -> DataFrame:
    """Pairs of events: unit i/2 goes in at even i and out at odd i, 100 to 500 ms after the row's own time."""
    unit = div(F.col("value"), 2)
    stay_ms = (unit % 5 + 1) * 100
    out_ts = F.timestamp_micros(F.unix_micros("timestamp") + stay_ms * 1000)
    is_in = F.col("value") % 2 == 0
    return index.select(
        F.when(is_in, F.col("timestamp")).otherwise(out_ts).alias("ts"),
        (unit % lines).cast("int").alias("line"),
        (unit % stations).cast("int").alias("station"),
        unit.alias("unit_id"),
        F.when(is_in, F.lit(IN)).otherwise(F.lit(OUT)).alias("action"),
    )


# Lengths of the random strings.
STRING_LENGTHS = {"first_name": 8, "second_name": 12, "country": 2, "city": 20, "occupation": 10}


def generic_events(index: DataFrame, seed: int = 42) -> DataFrame:
    """Eight fields: id, time, ``value<i>`` and five random strings."""
    strings = [
        F.randstr(length, F.lit(seed + i)).alias(name) for i, (name, length) in enumerate(STRING_LENGTHS.items())
    ]
    return index.select(
        F.col("value").alias("id"), "timestamp", F.concat(F.lit("value"), F.col("value")).alias("value"), *strings
    )


def sensor_readings(
    spark: SparkSession,
    start: datetime,
    seconds: int,
    lines: int = 2,
    stations: int = 2,
    jitter: bool = True,
    seed: int = 42,
) -> DataFrame:
    """One reading per second, line and station; in second i about 10 * i kWh, with time and value jittered."""
    micros = int(start.timestamp() * 1_000_000)
    per_second = lines * stations
    index = spark.range(seconds * per_second)
    second = div(F.col("id"), per_second)
    slot = F.col("id") % per_second
    shake_us = F.floor(F.rand(seed) * 20 - 10).cast("bigint") * 1000 if jitter else F.lit(0).cast("bigint")
    noise = F.rand(seed + 1) * 2 - 1 if jitter else F.lit(0.0)
    return index.select(
        F.timestamp_micros(F.lit(micros) + second * 1_000_000 + shake_us).alias("ts"),
        div(slot, stations).cast("int").alias("line"),
        (slot % stations).cast("int").alias("station"),
        F.create_map(
            F.lit(ENERGY_CONSUMPTION), reading(ENERGY_CONSUMPTION, second * 10.0 + noise, "kWh")
        ).alias("readings"),
    )
