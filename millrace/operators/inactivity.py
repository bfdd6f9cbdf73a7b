"""Stations that fell silent."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.time import seconds, to_millis
from millrace.operators.slices import ROWS_PER_SLICE, find_cuts, next_row, scan
from millrace.schemas import LINE_STATION


def with_next(events: DataFrame, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE) -> DataFrame:
    """Each event with the time of its station's next one in ``_next``."""
    order = ["ts", tie]
    cuts = find_cuts(events, LINE_STATION, order, rows_per_slice)
    return scan(events, LINE_STATION, order, [next_row("_next", "ts", order)], cuts)


def as_alerts(events: DataFrame) -> DataFrame:
    """The report of a silence after each event."""
    return events.select(
        F.col("line").cast("bigint").alias("line"),
        F.col("station").cast("bigint").alias("station"),
        to_millis("ts").alias("timestamp"),
    )


def _alerts(
    events: DataFrame,
    period_seconds: float,
    until: datetime | None,
    equal_gap_alerts: bool,
    tie: str,
    rows_per_slice: int | None,
) -> DataFrame:
    rows = with_next(events.select(*LINE_STATION, "ts", tie), tie, rows_per_slice)
    due = F.col("ts") + seconds(period_seconds)
    silent = F.col("_next") >= due if equal_gap_alerts else F.col("_next") > due
    # The last event of a station alerts when the final watermark passes its due time.
    ended: Column = F.lit(True) if until is None else due <= F.lit(until).cast("timestamp_ntz")
    return as_alerts(rows.where(F.when(F.col("_next").isNull(), ended).otherwise(silent)))


def inactivity_in_order(
    events: DataFrame,
    period_seconds: float,
    until: datetime | None = None,
    tie: str = "event_id",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Last-seen time of each silence longer than the period, as a timer restarted by every event reports it.

    An event exactly at the end of the period still cancels the alert. ``until`` is the final watermark; None means
    the input has ended.
    """
    return _alerts(events, period_seconds, until, False, tie, rows_per_slice)


def inactivity_buffered(
    events: DataFrame,
    period_seconds: float,
    until: datetime | None = None,
    tie: str = "event_id",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Last-seen time of each silence of at least the period, events taken in event-time order."""
    return _alerts(events, period_seconds, until, True, tie, rows_per_slice)
