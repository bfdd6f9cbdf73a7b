"""Energy used per unit: as-of join, pairing, sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.asof import asof_join
from millrace.operators.pairing import pair_in_out, sum_per_unit
from millrace.operators.slices import ROWS_PER_SLICE, find_cuts
from millrace.schemas import LINE_STATION, OUT


def station_energy(
    events: DataFrame,
    readings: DataFrame,
    energy: str = "energy",
    reading_tie: str | None = "reading_id",
    tie: str = "event_id",
    rows_per_slice: int | None = ROWS_PER_SLICE,
    visit_rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Visits with the difference of the meter between IN and OUT."""
    needed = readings.select(*LINE_STATION, "ts", *([reading_tie] if reading_tie else []), energy)
    enriched = asof_join(events, needed, event_tie=tie, reading_tie=reading_tie, rows_per_slice=rows_per_slice)
    flat = enriched.withColumn("_energy", F.col("reading").getField(energy)).drop("reading")
    return pair_in_out(flat, "_energy", tie, visit_rows_per_slice)


def energy_per_unit(
    events: DataFrame,
    readings: DataFrame,
    stations: int,
    energy: str = "energy",
    reading_tie: str | None = "reading_id",
    tie: str = "event_id",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Total energy of each unit over its ``stations`` visits.

    Large units are looked for in the raw events (OUT events carry the order of the visits), before any shuffle. A
    visit cannot be large where no unit is, so this one look serves both later steps.
    """
    outs = events.where(F.col("action") == OUT).withColumnRenamed("ts", "end_ts")
    cuts = find_cuts(outs, ["unit_id"], ["end_ts", tie], rows_per_slice)
    visits = station_energy(
        events, readings, energy, reading_tie, tie, rows_per_slice, None if cuts is None else rows_per_slice
    )
    if cuts is not None:
        # The sliced sum reads the visits twice.
        visits = visits.checkpoint()
    return sum_per_unit(visits, stations, ("end_ts", tie), cuts, None)
