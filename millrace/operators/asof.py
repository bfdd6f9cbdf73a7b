"""Joins in time: latest reading at or before an event, and nearest reading in either direction.

Both inputs are tagged and united, then one ordered scan per key finds the neighbours: one exchange, sort-based,
spilling, and no pair of rows is ever built that is not in the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.time import duration_ms, seconds
from millrace.operators.slices import ROWS_PER_SLICE, Fold, find_cuts, last_known, next_known, scan
from millrace.schemas import LINE_STATION

# Readings sort before events of the same instant, so that a reading at the event's own time matches.
READING, EVENT = 0, 1
ORDER = ["_ts", "_side", "_tie"]


def _tie(column: str | None) -> Column:
    return F.lit(0).cast("bigint") if column is None else F.col(column).cast("bigint")


def _timeline(
    events: DataFrame, readings: DataFrame, keys: Sequence[str], event_tie: str | None, reading_tie: str | None
) -> DataFrame:
    # The event's time travels once, as the sort column.
    left = events.select(
        *keys,
        F.col("ts").alias("_ts"),
        F.lit(EVENT).alias("_side"),
        _tie(event_tie).alias("_tie"),
        F.struct(*[c for c in events.columns if c not in [*keys, "ts"]]).alias("_event"),
    )
    right = readings.select(
        *keys,
        F.col("ts").alias("_ts"),
        F.lit(READING).alias("_side"),
        _tie(reading_tie).alias("_tie"),
        F.struct(*[c for c in readings.columns if c not in keys]).alias("_reading"),
    )
    return left.unionByName(right, allowMissingColumns=True)


def _matched(
    events: DataFrame,
    readings: DataFrame,
    keys: Sequence[str],
    event_tie: str | None,
    reading_tie: str | None,
    folds: Sequence[Fold],
    rows_per_slice: int | None,
) -> DataFrame:
    timeline = _timeline(events, readings, keys, event_tie, reading_tie)
    cuts = find_cuts(timeline, keys, ORDER, rows_per_slice)
    matched = scan(timeline, keys, ORDER, folds, cuts).where(F.col("_side") == EVENT)
    return matched.select(*keys, F.col("_ts").alias("ts"), "_event.*", *[f.name for f in folds])


def asof_join(
    events: DataFrame,
    readings: DataFrame,
    keys: Sequence[str] = LINE_STATION,
    event_tie: str | None = "event_id",
    reading_tie: str | None = None,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Every event with ``reading``, the latest reading of its key at or before it (null if there is none).

    Readings of one instant are ordered by ``reading_tie``; the last wins.
    """
    fold = last_known("reading", F.col("_reading"), ORDER)
    matched = _matched(events, readings, keys, event_tie, reading_tie, [fold], rows_per_slice)
    return matched.select(*events.columns, "reading")


def asof_join_with_lateness(
    events: DataFrame,
    readings: DataFrame,
    lateness_seconds: float,
    keys: Sequence[str] = LINE_STATION,
    watermark: str = "watermark",
    event_tie: str | None = "event_id",
    reading_tie: str | None = None,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """The as-of join for events that carry the watermark they arrived at.

    Kept are events newer than ``watermark - lateness``; a null watermark (nothing seen yet) keeps the event. The
    filter runs before the shuffle.
    """
    in_time = events.where(
        F.col(watermark).isNull() | (F.col("ts") > F.col(watermark) - seconds(lateness_seconds))
    )
    return asof_join(in_time, readings, keys, event_tie, reading_tie, rows_per_slice)


def nearest_join(
    events: DataFrame,
    readings: DataFrame,
    keys: Sequence[str] = LINE_STATION,
    event_tie: str | None = "event_id",
    reading_tie: str | None = None,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Events with the reading closest in time, before or after, and ``time_delta_ms``.

    Of two equally close readings the earlier one wins. Events of a key without readings are dropped.
    """
    folds = [
        last_known("_back", F.col("_reading"), ORDER),
        next_known("_ahead", F.col("_reading"), ORDER),
    ]
    matched = _matched(events, readings, keys, event_tie, reading_tie, folds, rows_per_slice)
    back, ahead = F.col("ts") - F.col("_back.ts"), F.col("_ahead.ts") - F.col("ts")
    take_back = F.col("_ahead").isNull() | (back <= ahead)
    return (
        matched.withColumn("reading", F.when(take_back, F.col("_back")).otherwise(F.col("_ahead")))
        .where(F.col("reading").isNotNull())
        .select(*events.columns, "reading", F.abs(duration_ms("ts", "reading.ts")).alias("time_delta_ms"))
    )


def prune_readings(
    readings: DataFrame, boundary: Column, keys: Sequence[str] = LINE_STATION, tie: str = "reading_id"
) -> DataFrame:
    """What an as-of join still needs for events after ``boundary``.

    Readings newer than the boundary pass without a shuffle; of the older ones each key keeps its latest, found with
    partial aggregation.
    """
    newer = readings.where(F.col("ts") > boundary)
    latest = (
        readings.where(F.col("ts") <= boundary)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*[c for c in readings.columns if c not in keys]), F.struct("ts", tie)).alias("_r"))
        .select(*keys, "_r.*")
    )
    return newer.unionByName(latest)
