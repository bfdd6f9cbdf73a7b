"""Watermarks, tumbling counts and the energy chain as streaming queries."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import counts
from millrace.schemas import IN, OUT, VISIT
from millrace.streaming import joins, units

# Fixed value: the disorder the analyses allow for.
DISORDER = "10 seconds"


def with_disorder(events: DataFrame, bound: str = DISORDER) -> DataFrame:
    """Event time with a bound on how far rows may be out of order."""
    return events.withWatermark("ts", bound)


def in_order(events: DataFrame) -> DataFrame:
    """Event time that only rises."""
    return events.withWatermark("ts", "0 seconds")


def units_per_window(events: DataFrame, stations: int, bound: str = DISORDER, width: str = counts.WINDOW) -> DataFrame:
    """Finished units per line and window, emitted once when the watermark passes the window.

    Every event moves the watermark, not only those that finish a unit. A filter would be pushed below the watermark,
    so the condition is in the aggregate instead; partial aggregation keeps the shuffle as small as with the filter.
    """
    finished = (F.col("station") == stations - 1) & (F.col("action") == OUT)
    return (
        with_disorder(events, bound)
        .groupBy(F.window("ts", width).alias("window"), "line")
        .agg(F.count_if(finished).alias("count"))
        .where(F.col("count") > 0)
        .select("line", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "count")
    )


def pair_in_out(
    events: DataFrame,
    longest: str,
    energy: str | None = None,
    visit: str | None = None,
    bound: str = DISORDER,
) -> DataFrame:
    """Visits, as soon as both events are there: the IN events joined with the OUT events of the unit at the station.

    For units that are at a station once, or events that carry the number of the ``visit``. Either event may come first.
    Events more than ``longest`` apart are no visit; this also bounds the state, which forgets an event once the watermark
    is so far past it.
    """
    keys = [*VISIT, *([visit] if visit else [])]
    meter = F.lit(None).cast("double") if energy is None else F.col(energy)

    def side(action: str, ts: str, value: str) -> DataFrame:
        # The watermark goes by all events, not only those of one action.
        seen = with_disorder(events, bound).where(F.col("action") == action)
        return seen.select(*[F.col(k).alias(f"{ts}_{k}") for k in keys], F.col("ts").alias(ts), meter.alias(value))

    same = [F.col(f"start_ts_{k}") == F.col(f"end_ts_{k}") for k in keys]
    span = F.expr(f"end_ts >= start_ts - INTERVAL {longest} AND end_ts <= start_ts + INTERVAL {longest}")
    joined = side(IN, "start_ts", "_before").join(side(OUT, "end_ts", "_after"), reduce(and_, same) & span)
    used = (F.col("_after") - F.col("_before")).alias("energy_consumption")
    return joined.select(*[F.col(f"start_ts_{k}").alias(k) for k in VISIT], "start_ts", "end_ts", used)


def energy_per_unit(
    events: DataFrame, readings: DataFrame, stations: int, energy: str = "energy", salts: int = joins.SALTS
) -> DataFrame:
    """As-of join, pairing and sum as three stateful steps of one query.

    The watermark of the query is the lower one of the two sources, so the source that runs ahead waits; bound its
    micro-batches at the source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) to keep the state small.
    """
    enriched = joins.asof_join(with_disorder(events), with_disorder(readings), [energy], salts=salts)
    return units.sum_per_unit(units.pair_in_out(enriched, energy), stations)
