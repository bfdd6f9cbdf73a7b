"""State per (line, station): running counts, duration reports and inactivity alerts.

A micro-batch's rows of one station are held by one task, so its size is to be set at the source
(``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``). ``inactivity_sessions`` has no such need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.time import to_millis
from millrace.operators.rows import out_events
from millrace.schemas import IN, INACTIVITY_ALERT, LINE_STATION, STATION_AVERAGE, STATION_COUNT, STATION_REPORT
from millrace.streaming.buckets import BUCKET_SECONDS, Buckets

COUNT_STATE, STATS_STATE, INSIDE_STATE, TOTALS_STATE = "unitCount", "stationStats", "inProgress", "durationTotals"


def micros(ts: str = "ts") -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def tie_column(tie: str | None) -> Column:
    return F.lit(0).cast("bigint") if tie is None else F.col(tie).cast("bigint")


class RunningCount(StatefulProcessor):
    """Numbers the rows of a station, chunk by chunk."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState(COUNT_STATE, "unit_count BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = self.count.get()[0] if self.count.exists() else 0
        for chunk in rows:
            numbers = np.arange(seen + 1, seen + len(chunk) + 1)
            seen += len(chunk)
            yield pd.DataFrame({"line": key[0], "station": key[1], "unit_count": numbers})
        self.count.update((seen,))

    def close(self) -> None:
        pass


def running_station_count(events: DataFrame) -> DataFrame:
    """Each OUT event gives its station's number of OUT events so far."""
    outs = out_events(events).select(*LINE_STATION)
    return outs.groupBy(*LINE_STATION).transformWithStateInPandas(RunningCount(), STATION_COUNT, "append", "none")


class DurationReport(StatefulProcessor):
    """Times between IN and OUT of a unit, and the station's count, minimum and maximum of them.

    Rows of a micro-batch are taken in order of (ts, tie). A unit touches the map state only where it was inside the
    station before the micro-batch or still is after it. With ``average`` a second value state holds the total, so
    that a query started without it can be resumed with it.
    """

    def __init__(self, average: bool = False) -> None:
        self.average = average

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stats = handle.getValueState(
            STATS_STATE, "unit_count BIGINT, min_duration_ms BIGINT, max_duration_ms BIGINT"
        )
        self.inside = handle.getMapState(INSIDE_STATE, "unit_id BIGINT", "arrival_ms BIGINT")
        if self.average:
            self.totals = handle.getValueState(TOTALS_STATE, "timed BIGINT, duration_ms BIGINT")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        # Counts continue; the shortest and longest time are only known from here on.
        self.stats.update((int(initialState["unit_count"].iloc[0]), None, None))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["us", "tie"], ignore_index=True)
        batch["ms"] = batch["us"] // 1000
        arrival = self._arrivals(batch)
        done = (batch["action"] != IN) & arrival.notna()
        duration = batch.loc[done, "ms"].to_numpy() - arrival[done].to_numpy(dtype="int64")
        if not len(duration):
            return
        count, low, high, timed, total = self._known()
        lows = np.minimum.accumulate(duration)
        highs = np.maximum.accumulate(duration)
        report = pd.DataFrame(
            {
                "line": key[0],
                "station": key[1],
                "unit_count": count + np.arange(1, len(duration) + 1),
                "min_duration_ms": lows if low is None else np.minimum(lows, low),
                "max_duration_ms": highs if high is None else np.maximum(highs, high),
            }
        )
        totals = total + np.cumsum(duration)
        if self.average:
            report["avg_duration_ms"] = totals / (timed + np.arange(1, len(duration) + 1))
        last = report[["unit_count", "min_duration_ms", "max_duration_ms"]].iloc[-1]
        self._keep((*map(int, last), timed + len(duration), int(totals[-1])))
        yield report

    def _known(self) -> tuple:
        """Count, shortest and longest time, and the number and sum of the times whose total is kept."""
        stats = self.stats.get() if self.stats.exists() else (0, None, None)
        return (*stats, *(self.totals.get() if self.average and self.totals.exists() else (0, 0)))

    def _keep(self, known: tuple) -> None:
        self.stats.update(known[:3])
        if self.average:
            self.totals.update(known[3:])

    def _arrivals(self, batch: pd.DataFrame) -> pd.Series:
        """Per row the time of the unit's IN just before it (nullable), with the map state brought up to date."""
        previous = batch.groupby("unit_id", sort=False)[["action", "ms"]].shift()
        arrival = previous["ms"].where(previous["action"] == IN).astype("Int64")
        goes_in = batch["action"] == IN
        first = ~batch["unit_id"].duplicated()
        leaving_open = ~batch["unit_id"].duplicated(keep="last") & goes_in
        overwritten = goes_in & batch["unit_id"].isin(batch.loc[leaving_open, "unit_id"])
        for i in batch.index[first & ~overwritten]:
            unit = (int(batch.at[i, "unit_id"]),)
            if self.inside.containsKey(unit):
                arrival.at[i] = self.inside.getValue(unit)[0]
                self.inside.removeKey(unit)
        for unit_id, ms in batch.loc[leaving_open, ["unit_id", "ms"]].itertuples(index=False):
            self.inside.updateValue((int(unit_id),), (int(ms),))
        return arrival

    def close(self) -> None:
        pass


class EvolvedReport(DurationReport):
    """The report with its average, the total being two more fields of the value that the report without it keeps.

    A value that was written without these fields gives them as null; the average then begins with the first time after it.
    Spark reads such values only from state that is encoded as Avro (``session.evolvable``), also in the query that wrote them.
    """

    def __init__(self) -> None:
        super().__init__(average=True)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stats = handle.getValueState(
            STATS_STATE,
            "unit_count BIGINT, min_duration_ms BIGINT, max_duration_ms BIGINT, timed BIGINT, duration_ms BIGINT",
        )
        self.inside = handle.getMapState(INSIDE_STATE, "unit_id BIGINT", "arrival_ms BIGINT")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.stats.update((int(initialState["unit_count"].iloc[0]), None, None, 0, 0))

    def _known(self) -> tuple:
        count, low, high, timed, total = self.stats.get() if self.stats.exists() else (0, None, None, 0, 0)
        return count, low, high, timed or 0, total or 0

    def _keep(self, known: tuple) -> None:
        self.stats.update(known)


def station_report(
    events: DataFrame,
    tie: str | None = None,
    average: bool = False,
    initial_counts: DataFrame | None = None,
    evolved: bool = False,
) -> DataFrame:
    """Each OUT event with a known IN gives its station's report; an OUT without IN is skipped.

    ``initial_counts`` (line, station, unit_count) continues the counts of an earlier query. With ``evolved`` the average is
    kept in the same variable as the rest (``EvolvedReport``).
    """
    rows = events.select(*LINE_STATION, "unit_id", "action", micros().alias("us"), tie_column(tie).alias("tie"))
    initial: GroupedData | None = initial_counts and initial_counts.groupBy(*LINE_STATION)
    return rows.groupBy(*LINE_STATION).transformWithStateInPandas(
        EvolvedReport() if evolved else DurationReport(average),
        STATION_AVERAGE if average or evolved else STATION_REPORT,
        "append",
        "none",
        initialState=initial,
    )


def reset_timer(handle: StatefulProcessorHandle, due_ms: int | None) -> None:
    """One timer per key at most."""
    for timer in list(handle.listTimers()):
        handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
    if due_ms is not None:
        handle.registerTimer(int(due_ms))


def _alerts(key, last_seen_us: list[int]) -> pd.DataFrame:
    return pd.DataFrame(
        {"line": key[0], "station": key[1], "timestamp": [us // 1000 for us in last_seen_us]}, dtype="int64"
    )


class InOrderInactivity(StatefulProcessor):
    """A timer per station, restarted by every event; when it fires the last-seen time is reported."""

    def __init__(self, period_ms: int) -> None:
        self.period_ms = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last_seen = handle.getValueState("lastSeen", "us BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = np.sort(np.concatenate([chunk["us"].to_numpy() for chunk in rows]))
        if self.last_seen.exists():
            seen = np.r_[self.last_seen.get()[0], seen]
        # An event exactly at the end of the period still cancels the alert.
        silent = seen[:-1][np.diff(seen) > self.period_ms * 1000]
        last = int(seen[-1])
        self.last_seen.update((last,))
        reset_timer(self.handle, -(-last // 1000) + self.period_ms)
        if len(silent):
            yield _alerts(key, [int(us) for us in silent])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last_seen.get()[0]
        self.last_seen.clear()
        yield _alerts(key, [last])

    def close(self) -> None:
        pass


class BufferedInactivity(StatefulProcessor):
    """Events wait in time buckets until the watermark reaches them and are then applied in event-time order.

    A silence of exactly the period alerts. Events behind the watermark are dropped. Of what arrives in one go only distinct
    times are kept.
    """

    def __init__(self, period_ms: int, bucket_seconds: float) -> None:
        self.period_us = period_ms * 1000
        self.width_us = int(bucket_seconds * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = Buckets(handle, "waiting", "us BIGINT", self.width_us)
        self.last_seen = handle.getValueState("lastSeen", "us BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        self.waiting.load()
        for chunk in rows:
            us = np.unique(chunk["us"].to_numpy(dtype="int64"))
            self.waiting.add(pd.DataFrame({"us": us[us >= watermark]}))
        yield from self._advance(key, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.waiting.load()
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def _advance(self, key, watermark: int) -> Iterator[pd.DataFrame]:
        held = last = int(self.last_seen.get()[0]) if self.last_seen.exists() else None
        for due in self.waiting.take(watermark):
            seen = np.unique(due["us"].to_numpy())
            if not len(seen):
                continue
            seen = seen if last is None else np.r_[last, seen]
            last = int(seen[-1])
            silent = seen[:-1][np.diff(seen) >= self.period_us]
            if len(silent):
                yield _alerts(key, silent.tolist())
        if last is not None and last + self.period_us <= watermark:
            yield _alerts(key, [last])
            last = None

        if last is None and held is not None:
            self.last_seen.clear()
        elif last != held:
            self.last_seen.update((last,))
        due = [t for t in (self.waiting.first(), None if last is None else last + self.period_us) if t is not None]
        reset_timer(self.handle, -(-min(due) // 1000) if due else None)
        self.waiting.save()

    def close(self) -> None:
        pass


def _inactivity(events: DataFrame, processor: StatefulProcessor) -> DataFrame:
    rows = events.select(*LINE_STATION, "ts", micros().alias("us"))
    return rows.groupBy(*LINE_STATION).transformWithStateInPandas(
        processor, INACTIVITY_ALERT, "append", "eventTime"
    )


def inactivity_in_order(events: DataFrame, period_seconds: int) -> DataFrame:
    """Alerts for events (with a watermark on ``ts``) that arrive in order."""
    return _inactivity(events, InOrderInactivity(period_seconds * 1000))


def inactivity_buffered(
    events: DataFrame, period_seconds: int, bucket_seconds: float = BUCKET_SECONDS
) -> DataFrame:
    """Alerts for events (with a watermark on ``ts``) in any order within the watermark."""
    return _inactivity(events, BufferedInactivity(period_seconds * 1000, bucket_seconds))


def inactivity_sessions(events: DataFrame, period_seconds: int) -> DataFrame:
    """The buffered alert as session windows: an alert is the end of a session whose gap is the period.

    All JVM-side, with sessions merged before the shuffle, so that a station with a large share of the events costs
    one row per task. It differs from ``inactivity_buffered`` for late events only: one behind the watermark is
    still merged while its session is open.
    """
    # Sessions that just touch are merged, while a silence of exactly the period is to alert.
    gap = f"{period_seconds * 1_000_000 - 1} microseconds"
    session = F.session_window("ts", gap).alias("session")
    return (
        events.groupBy(session, *LINE_STATION)
        .agg(F.max("ts").alias("last_seen"))
        .select(
            F.col("line").cast("bigint").alias("line"),
            F.col("station").cast("bigint").alias("station"),
            to_millis("last_seen").alias("timestamp"),
        )
    )
