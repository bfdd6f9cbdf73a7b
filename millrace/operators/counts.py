"""Window counts and running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.time import seconds, to_millis
from millrace.operators.rows import finished_units, out_events
from millrace.operators.slices import ROWS_PER_SLICE, find_cuts, max_before, running_count, scan
from millrace.schemas import LINE_STATION

WINDOW = "5 minutes"


def units_per_window(events: DataFrame, stations: int, width: str = WINDOW) -> DataFrame:
    """Units finished per line and tumbling window; batch or streaming (append mode, after a watermark).

    The count is partially aggregated before the shuffle, so a hot line sends one row per task and window.
    """
    return (
        finished_units(events, stations)
        .groupBy(F.window("ts", width).alias("window"), "line")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "line", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "count"
        )
    )


def in_millis(statistics: DataFrame) -> DataFrame:
    """The same rows with window bounds as epoch milliseconds."""
    return statistics.select(
        "line",
        to_millis("window_start").alias("window_start"),
        to_millis("window_end").alias("window_end"),
        "count",
    )


def arrival_watermark(
    events: DataFrame,
    bound_seconds: float,
    ts: str = "ts",
    arrival: str = "event_id",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``watermark``: the highest time among rows that arrived earlier, minus the allowed disorder.

    Null for the first row. The watermark is one for the whole input, so the input is a single key; it is cut into
    slices of the arrival order.
    """
    keyed = events.withColumn("_all", F.lit(0))
    cuts = find_cuts(keyed, ["_all"], [arrival], rows_per_slice)
    rows = scan(keyed, ["_all"], [arrival], [max_before("_highest", F.col(ts))], cuts)
    return rows.withColumn("watermark", F.col("_highest") - seconds(bound_seconds)).drop("_all", "_highest")


def without_late(events: DataFrame, width: str = WINDOW, watermark: str = "watermark") -> DataFrame:
    """Drop rows whose window had already closed at the watermark they arrived at."""
    end = F.window("ts", width)["end"]
    open_rows = events.withColumn("_end", end)
    return open_rows.where(F.col(watermark).isNull() | (F.col("_end") > F.col(watermark))).drop("_end", watermark)


def running_station_count(
    events: DataFrame, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE
) -> DataFrame:
    """Each OUT event with the number of OUT events of its station so far."""
    outs = out_events(events)
    cuts = find_cuts(outs, LINE_STATION, ["ts", tie], rows_per_slice)
    return scan(outs, LINE_STATION, ["ts", tie], [running_count("unit_count")], cuts)
