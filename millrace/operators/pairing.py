"""Units at stations: IN paired with OUT, and totals per unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.slices import ROWS_PER_SLICE, Cuts, find_cuts, running_count, scan
from millrace.schemas import IN, OUT, VISIT


def pair_in_out(
    events: DataFrame,
    energy: str | None = None,
    tie: str = "event_id",
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """The n-th IN of a unit at a station with the n-th OUT there; an event without partner gives no row.

    With ``energy`` (a meter column) the difference OUT - IN is added, null where either is null.
    """
    order = ["ts", tie]
    by_action = [*VISIT, "action"]
    cuts = find_cuts(events, by_action, order, rows_per_slice)
    if cuts is None:
        # One exchange on the visit serves the numbering and the grouping below.
        events = events.repartition(*VISIT)
    numbered = scan(events, by_action, order, [running_count("_visit")], cuts)

    def at(action: str, column: str) -> Column:
        return F.max(F.when(F.col("action") == action, F.col(column)))

    meter = [] if energy is None else [at(IN, energy).alias("_first"), at(OUT, energy).alias("_last")]
    paired = (
        numbered.groupBy(*VISIT, "_visit")
        .agg(
            at(IN, "ts").alias("start_ts"),
            at(OUT, "ts").alias("end_ts"),
            at(OUT, tie).alias(tie),
            *meter,
        )
        .where(F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull())
    )
    consumption = [] if energy is None else [(F.col("_last") - F.col("_first")).alias("energy_consumption")]
    return paired.select(*VISIT, "start_ts", "end_ts", tie, *consumption)


def sum_per_unit(
    visits: DataFrame,
    stations: int,
    order: tuple[str, ...] = ("end_ts", "event_id"),
    cuts: Cuts | None = None,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """Energy of every ``stations`` consecutive visits of a unit; an incomplete rest gives no row.

    A null energy counts as 0 and ``line`` is that of the last visit. ``cuts`` may be passed where they were found on
    a cheaper input with the same unit and order columns.
    """
    cuts = cuts or find_cuts(visits, ["unit_id"], order, rows_per_slice)
    numbered = scan(visits, ["unit_id"], order, [running_count("_n")], cuts)
    round_ = F.floor((F.col("_n") - 1) / stations).cast("bigint")
    return (
        numbered.groupBy("unit_id", round_.alias("_round"))
        .agg(
            F.count(F.lit(1)).alias("_visits"),
            F.sum(F.coalesce("energy_consumption", F.lit(0.0))).alias("energy_consumption"),
            F.max_by("line", "_n").cast("bigint").alias("line"),
        )
        .where(F.col("_visits") == stations)
        .select("unit_id", "line", "energy_consumption")
    )
