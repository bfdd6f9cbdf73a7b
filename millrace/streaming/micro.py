"""Streams in event time through the batch operators, micro-batch by micro-batch.

``transformWithState`` gives all rows of a key to one task, and what it answers can depend on how the input is cut. Here

- rows wait until the watermark (the latest time so far, less the disorder allowed) reaches them, so a step sees all rows
  in event-time order, whatever the cut;
- every step runs the batch operators, which cut a large key into slices, in the JVM and with all column types kept;
- what a step needs from earlier rows is in small tables: one row per station, unit inside or row that still waits;
- ``finish`` takes what waits when the input has ended, as a final watermark does.

The tables of micro-batch n are written under its number in the shared folder and are read by n + 1; a repeated
micro-batch overwrites its own, so nothing is counted twice. A row at or behind the watermark of an earlier micro-batch
is late: the query fails, unless a grace period is given, within which late rows take part and beyond which they are
dropped and counted (``dropped``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.time import seconds
from millrace.operators import asof, counts, durations, inactivity, pairing
from millrace.operators.slices import ROWS_PER_SLICE, find_cuts, running_count, scan
from millrace.schemas import IN, LINE_STATION, VISIT

Carried = dict[str, DataFrame]
HELD, CLOCK = "held", "clock"


class LateRows(RuntimeError):
    """Rows arrived behind the watermark: the input is more out of order than stated."""


@dataclass(frozen=True)
class Step:
    """``apply(rows, carried, until) -> (output, carried)`` and the names of the tables it carries.

    ``until`` is the watermark in microseconds: no later row is at or before it. None: the input has ended.
    """

    tables: tuple[str, ...]
    apply: Callable[[DataFrame, Carried | None, int | None], tuple[DataFrame, Carried]]


def _micros(ts: str = "ts") -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def run(
    stream: DataFrame,
    step: Step,
    folder: str,
    checkpoint: str,
    available_now: bool = True,
    disorder_seconds: float = 0,
    grace_seconds: float | None = None,
) -> StreamingQuery:
    """Run the step for each micro-batch of a stream with a column ``ts``; outputs go to ``folder/output``.

    ``checkpoint`` and ``folder`` belong together: a query that is resumed needs both.
    """
    spark = stream.sparkSession
    tables = (*step.tables, HELD, CLOCK)

    def handle(rows: DataFrame, batch_id: int) -> None:
        before = _carried(spark, folder, tables, batch_id - 1) if batch_id else None
        then, dropped = before[CLOCK].first() if before else (None, 0)
        # Read by the output and by the tables that are carried on.
        rows = rows.withColumn("_us", _micros()).persist()
        try:
            latest, late, lost = rows.agg(F.max("_us"), *_lateness(then, grace_seconds)).first()
            if late and grace_seconds is None:
                raise LateRows(f"{late} rows of micro-batch {batch_id} are behind the watermark")
            if lost:
                rows = rows.where(F.coalesce(F.col("_us") > then - int(grace_seconds * 1e6), F.lit(True)))
            until = max((t for t in (then, None if latest is None else latest - int(disorder_seconds * 1e6)) if t is not None), default=None)
            waiting = rows if before is None else rows.unionByName(before[HELD])
            ready = F.coalesce(F.col("_us") <= F.lit(until), F.lit(False))
            result, after = step.apply(waiting.where(ready).drop("_us"), before, until)
            clock = spark.range(1).select(F.lit(until).cast("long").alias("until"), F.lit(dropped + lost).cast("long").alias("dropped"))
            _write(result, after | {HELD: waiting.where(~ready), CLOCK: clock}, folder, batch_id)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _lateness(then: int | None, grace_seconds: float | None) -> list[Column]:
    """How many rows are behind the watermark, and how many of them beyond the grace period."""
    if then is None:
        return [F.lit(0), F.lit(0)]
    beyond = 0 if grace_seconds is None else F.count_if(F.col("_us") <= then - int(grace_seconds * 1e6))
    return [F.count_if(F.col("_us") <= then), F.lit(0) if grace_seconds is None else beyond]


def finish(stream: DataFrame, step: Step, folder: str) -> None:
    """The end of the input: what still waits goes through the step."""
    spark = stream.sparkSession
    last = _last(spark, folder)
    if last is None:
        result, _ = step.apply(spark.createDataFrame([], stream.schema), None, None)
        result.write.parquet(f"{folder}/output/batch=0")
        return
    before = _carried(spark, folder, (*step.tables, HELD, CLOCK), last)
    result, _ = step.apply(before[HELD].drop("_us"), before, None)
    result.write.mode("overwrite").parquet(f"{folder}/output/batch={last + 1}")


def to_table(stream: DataFrame, step: Step, folder: str, **options) -> DataFrame:
    """Process all input there is, to its end, and return the output."""
    run(stream, step, folder, f"{folder}/checkpoint", **options).awaitTermination()
    finish(stream, step, folder)
    return output(stream.sparkSession, folder).drop("batch")


def _write(result: DataFrame, after: Carried, folder: str, batch_id: int) -> None:
    result.write.mode("overwrite").parquet(f"{folder}/output/batch={batch_id}")
    for name, table in after.items():
        table.write.mode("overwrite").parquet(f"{folder}/carried/{name}/{batch_id}")


def _carried(spark: SparkSession, folder: str, names: Sequence[str], batch_id: int) -> Carried:
    return {name: spark.read.parquet(f"{folder}/carried/{name}/{batch_id}") for name in names}


def _last(spark: SparkSession, folder: str) -> int | None:
    """The number of the latest micro-batch that is complete."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/carried/{CLOCK}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    return max(int(status.getPath().getName()) for status in files.listStatus(path))


def output(spark: SparkSession, folder: str) -> DataFrame:
    """All output so far, with the micro-batch it came from in ``batch``."""
    return spark.read.parquet(f"{folder}/output")


def dropped(spark: SparkSession, folder: str) -> int:
    """Rows so far that were later than the grace period."""
    last = _last(spark, folder)
    return 0 if last is None else _carried(spark, folder, (CLOCK,), last)[CLOCK].first()["dropped"]


def chain(first: Step, between: Callable[[DataFrame], DataFrame], second: Step) -> Step:
    """The output of one step as the input of the next."""

    def step(rows: DataFrame, before: Carried | None, until: int | None) -> tuple[DataFrame, Carried]:
        middle, one = first.apply(rows, before, until)
        result, two = second.apply(between(middle), before, until)
        return result, one | two

    return Step((*first.tables, *second.tables), step)


def _with(rows: DataFrame, before: Carried | None, name: str) -> DataFrame:
    return rows if before is None else rows.unionByName(before[name])


# --- Stations --------------------------------------------------------------------------------------------------------


def _stations(rows: DataFrame, before: Carried | None, aggregates: dict[str, Callable]) -> DataFrame:
    """Figures per station, together with those carried so far."""
    return (
        _with(rows, before, "stations")
        .groupBy(*LINE_STATION)
        .agg(*[merge(name).alias(name) for name, merge in aggregates.items()])
    )


def running_station_count(tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE) -> Step:
    """Each OUT event with its station's number of OUT events so far."""

    def step(rows: DataFrame, before: Carried | None, until: int | None) -> tuple[DataFrame, Carried]:
        counted = counts.running_station_count(rows, tie, rows_per_slice)
        ones = counted.select(*LINE_STATION, F.lit(1).cast("bigint").alias("_count"))
        after = {"stations": _stations(ones, before, {"_count": F.sum})}
        if before is not None:
            counted = (
                counted.join(before["stations"], LINE_STATION, "left")
                .withColumn("unit_count", F.col("unit_count") + F.coalesce("_count", F.lit(0)))
                .drop("_count")
            )
        return counted, after

    return Step(("stations",), step)


def station_report(tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE) -> Step:
    """Each OUT event with a known IN, with its station's count, minimum, maximum and average duration so far."""
    merges = {"_count": F.sum, "_low": F.min, "_high": F.max, "_sum": F.sum}

    def step(rows: DataFrame, before: Carried | None, until: int | None) -> tuple[DataFrame, Carried]:
        events = _with(rows.select(*VISIT, "ts", tie, "action"), before, "inside")
        stats = durations.running_stats(events, tie, rows_per_slice)
        single = stats.select(
            *LINE_STATION,
            F.lit(1).cast("bigint").alias("_count"),
            F.col("duration_ms").alias("_low"),
            F.col("duration_ms").alias("_high"),
            F.col("duration_ms").alias("_sum"),
        )
        # Units whose latest event is an IN are still inside.
        latest = events.groupBy(*VISIT).agg(
            F.max_by(F.struct("ts", tie, "action"), F.struct("ts", tie)).alias("_last")
        )
        after = {
            "stations": _stations(single, before, merges),
            "inside": latest.select(*VISIT, "_last.*").where(F.col("action") == IN),
        }
        if before is not None:
            stats = stats.join(before["stations"], LINE_STATION, "left").withColumns(
                {
                    "unit_count": F.col("unit_count") + F.coalesce("_count", F.lit(0)),
                    "min_duration_ms": F.least("min_duration_ms", "_low"),
                    "max_duration_ms": F.greatest("max_duration_ms", "_high"),
                    "sum_duration_ms": F.col("sum_duration_ms") + F.coalesce("_sum", F.lit(0)),
                }
            )
        average = F.col("sum_duration_ms") / F.col("unit_count")
        report = stats.withColumn("avg_duration_ms", average)
        return report.drop("sum_duration_ms", "duration_ms", *merges), after

    return Step(("stations", "inside"), step)


def silences(
    period_seconds: float, equal_gap_alerts: bool, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE
) -> Step:
    """Inactivity alerts: as soon as the watermark is a period past a station's last event, or a later event shows the gap.

    ``equal_gap_alerts``: whether an event exactly at the end of the period comes too late.
    """

    def step(rows: DataFrame, before: Carried | None, until: int | None) -> tuple[DataFrame, Carried]:
        timeline = rows.select(*LINE_STATION, "ts", tie, F.lit(False).alias("_alerted"))
        followed = inactivity.with_next(_with(timeline, before, "last"), tie, rows_per_slice)
        last = F.col("_next").isNull()
        due = F.col("ts") + seconds(period_seconds)
        ended = F.lit(True) if until is None else F.unix_micros(due.cast("timestamp")) <= until
        silent = F.when(last, ended).otherwise(F.col("_next") >= due if equal_gap_alerts else F.col("_next") > due)
        alerts = inactivity.as_alerts(followed.where(silent & ~F.col("_alerted")))
        carried = followed.where(last).select(*LINE_STATION, "ts", tie, (F.col("_alerted") | ended).alias("_alerted"))
        return alerts, {"last": carried}

    return Step(("last",), step)


# --- Joins in time ---------------------------------------------------------------------------------------------------


def united(events: DataFrame, readings: DataFrame) -> DataFrame:
    """Two streams as one: line, station, ts, and the row of either side as it is."""

    def side(rows: DataFrame, other: DataFrame, name: str, empty: str) -> DataFrame:
        nothing = F.lit(None).cast(other.schema)
        return rows.select(*LINE_STATION, "ts", F.struct("*").alias(name), nothing.alias(empty))

    return side(events, readings, "event", "reading").unionByName(side(readings, events, "reading", "event"))


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.where("event IS NOT NULL").select("event.*"), rows.where("reading IS NOT NULL").select("reading.*")


def asof_join(
    reading_tie: str, tie: str = "event_id", grace_seconds: float = 0, rows_per_slice: int | None = ROWS_PER_SLICE
) -> Step:
    """Over ``united`` rows: each event with the latest reading at or before it.

    Carries the readings that a later event may need: those newer than the watermark less the grace period, and each
    station's latest before.
    """

    def step(rows: DataFrame, before: Carried | None, until: int | None) -> tuple[DataFrame, Carried]:
        events, readings = _sides(rows)
        known = _with(readings, before, "readings")
        joined = asof.asof_join(events, known, event_tie=tie, reading_tie=reading_tie, rows_per_slice=rows_per_slice)
        boundary = F.timestamp_micros(F.lit((until or 0) - int(grace_seconds * 1e6))).cast(known.schema["ts"].dataType)
        return joined, {"readings": asof.prune_readings(known, boundary, tie=reading_tie)}

    return Step(("readings",), step)


def nearest_join(reading_tie: str, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE) -> Step:
    """Over ``united`` rows: each event with the reading closest in time, before or after.

    An event is answered once no later reading can be closer: a reading at or behind it is known, or the watermark is as
    far ahead of it as its latest reading is behind. Until then it waits.
    """

    def step(rows: DataFrame, before: Carried | None, until: int | None) -> tuple[DataFrame, Carried]:
        events, readings = _sides(rows)
        events, known = _with(events, before, "waiting"), _with(readings, before, "readings")
        if until is None:
            settled = events
        else:
            latest = known.groupBy(*LINE_STATION).agg(F.max("ts").alias("_latest"))
            met = events.join(latest, LINE_STATION, "left")
            # The latest reading is either ahead of the event or the closest one behind it.
            reach = F.greatest(2 * _micros() - _micros("_latest"), _micros())
            known_one = F.col("_latest").isNotNull()
            sure = known_one & ((F.col("_latest") >= F.col("ts")) | (reach <= until))
            settled, open_ = met.where(sure).drop("_latest"), met.where(~sure).drop("_latest")
        joined = asof.nearest_join(settled, known, event_tie=tie, reading_tie=reading_tie, rows_per_slice=rows_per_slice)
        if until is None:
            return joined, {}
        # An event that waits has no reading ahead, so the latest one of its station is the one behind it.
        boundary = F.timestamp_micros(F.lit(until)).cast(known.schema["ts"].dataType)
        return joined, {"readings": asof.prune_readings(known, boundary, tie=reading_tie), "waiting": open_}

    return Step(("readings", "waiting"), step)


# --- Units -----------------------------------------------------------------------------------------------------------


def pair_in_out(energy: str | None = None, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE) -> Step:
    """The n-th IN of a unit at a station with the n-th OUT there. Carries the events without partner so far."""

    def step(rows: DataFrame, before: Carried | None, until: int | None) -> tuple[DataFrame, Carried]:
        columns = [*VISIT, "ts", tie, "action", *([energy] if energy else [])]
        events = _with(rows.select(columns), before, "single")
        keys, order = [*VISIT, "action"], ["ts", tie]
        numbered = scan(events, keys, order, [running_count("_visit")], find_cuts(events, keys, order, rows_per_slice))
        rest = [c for c in columns if c not in VISIT]
        single = numbered.groupBy(*VISIT, "_visit").agg(F.count("*").alias("_n"), F.max(F.struct(*rest)).alias("_row"))
        single = single.where("_n = 1").select(*VISIT, "_row.*").select(columns)
        return pairing.pair_in_out(events, energy, tie, rows_per_slice), {"single": single}

    return Step(("single",), step)


def sum_per_unit(stations: int, tie: str = "event_id", rows_per_slice: int | None = ROWS_PER_SLICE) -> Step:
    """Energy of every ``stations`` consecutive visits of a unit. Carries the visits of incomplete rounds."""
    columns = ["unit_id", "line", "end_ts", tie, "energy_consumption"]

    def step(rows: DataFrame, before: Carried | None, until: int | None) -> tuple[DataFrame, Carried]:
        visits = _with(rows.select(columns), before, "rest")
        order = ("end_ts", tie)
        cuts = find_cuts(visits, ["unit_id"], order, rows_per_slice)
        numbered = scan(visits, ["unit_id"], order, [running_count("_n")], cuts)
        totals = visits.groupBy("unit_id").agg((F.floor(F.count("*") / stations) * stations).alias("_full"))
        rest = numbered.join(totals, "unit_id").where("_n > _full").select(columns)
        return pairing.sum_per_unit(visits, stations, order, cuts, rows_per_slice), {"rest": rest}

    return Step(("rest",), step)


def energy_per_unit(energy: str, stations: int, reading_tie: str, tie: str = "event_id") -> Step:
    """As-of join, pairing and sum of ``united`` rows."""
    visits = chain(
        asof_join(reading_tie, tie),
        lambda joined: joined.withColumn("_energy", F.col("reading").getField(energy)).drop("reading"),
        pair_in_out("_energy", tie),
    )
    return chain(visits, lambda paired: paired, sum_per_unit(stations, tie))
