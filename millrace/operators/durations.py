"""Processing times per station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.time import duration_ms
from millrace.operators.slices import (
    ROWS_PER_SLICE,
    find_cuts,
    previous_row,
    running_count,
    running_max,
    running_min,
    running_sum,
    scan,
)
from millrace.schemas import IN, LINE_STATION, OUT, VISIT


def station_durations(
    events: DataFrame, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE
) -> DataFrame:
    """OUT events with ``duration_ms`` since the unit's latest IN there; an OUT without an open IN is skipped."""
    order = ["ts", tie]
    cuts = find_cuts(events, VISIT, order, rows_per_slice)
    last = previous_row("_last", F.struct("action", "ts"), order)
    return (
        scan(events, VISIT, order, [last], cuts)
        .where((F.col("action") == OUT) & (F.col("_last.action") == IN))
        .select(*VISIT, "ts", tie, duration_ms("_last.ts", "ts").alias("duration_ms"))
    )


def running_stats(
    events: DataFrame, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE
) -> DataFrame:
    """Per finished visit: its duration, and the station's count, minimum, maximum and sum of durations so far."""
    order = ["ts", tie]
    visits = station_durations(events, tie, rows_per_slice)
    # OUT events are a superset of the rows to scan and need no window to find.
    cuts = find_cuts(events.where(F.col("action") == OUT), LINE_STATION, order, rows_per_slice)
    duration = F.col("duration_ms")
    folds = [
        running_count("unit_count"),
        running_min("min_duration_ms", duration),
        running_max("max_duration_ms", duration),
        running_sum("sum_duration_ms", duration),
    ]
    return scan(visits, LINE_STATION, order, folds, cuts)


def station_report(
    events: DataFrame, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE
) -> DataFrame:
    """Per finished visit: the station's count, minimum, maximum and average duration so far."""
    stats = running_stats(events, tie, rows_per_slice)
    average = F.col("sum_duration_ms") / F.col("unit_count")
    return stats.withColumn("avg_duration_ms", average).drop("sum_duration_ms", "duration_ms")
