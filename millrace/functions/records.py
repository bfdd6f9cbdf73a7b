"""Access to sensor readings and the JSON form of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import ENERGY_CONSUMPTION, TEMPERATURE


def reading_value(readings: str | Column, sensor: str) -> Column:
    """Value of one sensor type; null where the map lacks it."""
    readings = F.col(readings) if isinstance(readings, str) else readings
    return F.try_element_at(readings, F.lit(sensor)).getField("value")


def energy(readings: str | Column) -> Column:
    return reading_value(readings, ENERGY_CONSUMPTION)


def temperature(readings: str | Column) -> Column:
    return reading_value(readings, TEMPERATURE)


def reading(sensor: str, value: Column, unit: str) -> Column:
    return F.struct(F.lit(sensor).alias("type"), value.alias("value"), F.lit(unit).alias("unit"))


def encode_json(df: DataFrame, column: str = "value") -> DataFrame:
    """One JSON object per row, in a single string column."""
    return df.select(F.to_json(F.struct("*")).alias(column))


def decode_json(df: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Typed columns from a JSON string (or binary) column; a row that does not parse fails the job."""
    parsed = F.from_json(F.col(column).cast("string"), schema, {"mode": "FAILFAST"})
    return df.select(parsed.alias("record")).select("record.*")
