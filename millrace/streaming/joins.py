"""Joins of an event stream with a reading stream in event time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.asof import EVENT, READING
from millrace.schemas import LINE_STATION
from millrace.streaming.buckets import BUCKET_SECONDS, Buckets
from millrace.streaming.stations import reset_timer, micros, tie_column

SALT = "_salt"
# Sub-keys per station. Readings are copied to each, so it pays where events far outnumber readings.
SALTS = 4


def _carried(field: T.StructField) -> T.StructField:
    """Integers travel as strings: with nulls, pandas would make floats of them."""
    integral = isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return T.StructField(field.name, T.StringType()) if integral else field


def _united(
    events: DataFrame, readings: DataFrame, values: Sequence[str], tie: str | None, reading_tie: str | None, salts: int
) -> tuple[DataFrame, list[T.StructField], list[T.StructField]]:
    """Both streams in one layout: keys, salt, ts, us, side, tie, event columns, reading values.

    Events are spread over ``salts`` sub-keys and every reading goes to all of them: each event still meets all
    readings of its station, while no task holds a whole busy station.
    """
    event_fields = [f for f in events.schema.fields if f.name not in [*LINE_STATION, "ts"]]
    value_fields = [f for f in readings.schema.fields if f.name in values]
    salt = F.pmod(F.xxhash64("ts", *[f.name for f in event_fields]), F.lit(salts)).cast("int")
    left = events.select(
        *LINE_STATION,
        salt.alias(SALT),
        "ts",
        micros().alias("us"),
        F.lit(EVENT).alias("side"),
        tie_column(tie).alias("tie"),
        *[F.col(f.name).cast(_carried(f).dataType).alias(f.name) for f in event_fields],
        *[F.lit(None).cast(_carried(f).dataType).alias(f"r_{f.name}") for f in value_fields],
    )
    right = readings.select(
        *LINE_STATION,
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(SALT),
        "ts",
        micros().alias("us"),
        F.lit(READING).alias("side"),
        tie_column(reading_tie).alias("tie"),
        *[F.lit(None).cast(_carried(f).dataType).alias(f.name) for f in event_fields],
        *[F.col(f.name).cast(_carried(f).dataType).alias(f"r_{f.name}") for f in value_fields],
    )
    return left.unionByName(right), event_fields, value_fields


BACKWARD, NEAREST, ARRIVED = "backward", "nearest", "arrived"


class TimeJoin(StatefulProcessor):
    """Keeps the readings of a station, matches its events, and prunes what no later event can match.

    Both sides lie in event-time buckets (see ``Buckets``). An event waits until its answer is certain, and one timer per
    key waits for the earliest:

    - ``backward``: when the watermark reaches the event, all readings at or before it have arrived.
    - ``nearest``: with L the latest reading at or before the watermark w, no later row can come between two times up to w,
      so events before L are certain; for the others L is the nearest from behind, and certain once w is as far ahead of the
      event as L is behind. Both together: events up to (w + L) / 2.
    - ``arrived``: answered at once from the readings that have arrived.

    Of the readings the newest bucket with one at or before the watermark stays, and all later ones.

    The stream's watermark delay includes ``lateness_ms``: the on-time boundary is the watermark plus the lateness.
    Events at or behind the boundary are matched at once, those at or behind the watermark itself are dropped where
    a lateness is set.
    """

    def __init__(
        self, event_state: str, reading_state: str, mode: str, lateness_ms: int | None, bucket_seconds: float
    ) -> None:
        self.event_state = event_state
        self.reading_state = reading_state
        self.mode = mode
        self.lateness_ms = lateness_ms
        self.width_us = int(bucket_seconds * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = Buckets(handle, "readings", self.reading_state, self.width_us)
        self.events = Buckets(handle, "events", self.event_state, self.width_us)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        self._load()
        at_once = []
        for chunk in rows:
            self.readings.add(chunk.loc[chunk["side"] == READING, self.readings.columns])
            events = chunk.loc[chunk["side"] == EVENT, self.events.columns]
            if self.lateness_ms is not None:
                events = events[events["us"] > watermark]
            if self.mode == ARRIVED:
                at_once.append(events)
            else:
                self.events.add(events)
        for events in at_once:
            yield from self._matched(key, events)
        yield from self._advance(key, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def _load(self) -> None:
        self.readings.load()
        self.events.load()

    def _advance(self, key, watermark: int) -> Iterator[pd.DataFrame]:
        lateness = (self.lateness_ms or 0) * 1000
        certain = watermark + lateness
        if self.mode == NEAREST:
            latest = self.readings.latest(watermark)
            certain = None if latest is None else (watermark + latest) // 2
        if certain is not None:
            for events in self.events.take(certain):
                yield from self._matched(key, events)
        self.readings.forget(watermark)

        due = self.events.first()
        if due is not None and self.mode == NEAREST and due <= watermark:
            # The event waits for a reading ahead of it, or until none can be nearer than the one behind it.
            ahead = self.readings.next(watermark)
            due = min((t for t in (ahead, None if latest is None else 2 * due - latest) if t is not None), default=None)
        elif due is not None:
            due -= lateness
        reset_timer(self.handle, None if due is None else max(-(-due // 1000), 0))
        self.readings.save()
        self.events.save()

    def _matched(self, key, events: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(events):
            return
        events = events.sort_values(["us", "tie"])
        us = events["us"].to_numpy(dtype="int64")
        readings = self.readings.around(int(us[0]), int(us[-1])).sort_values(["us", "tie"])
        times = readings["us"].to_numpy(dtype="int64")
        at = np.searchsorted(times, us, side="right") - 1
        if self.mode != BACKWARD:
            ahead = np.searchsorted(times, us, side="right")
            # Of readings of one instant the last counts behind an event, the first ahead of it.
            there = ahead < len(times)
            nearer = there & ((at < 0) | (times.take(ahead, mode="clip") - us < us - times.take(at, mode="clip"))) if len(times) else there
            at = np.where(nearer, ahead, at)
            events, us, at = events[at >= 0], us[at >= 0], at[at >= 0]
            if not len(events):
                return
        # Position -1, no reading, gives a row of nulls.
        found = readings.reset_index(drop=True).reindex(at)
        out = events.drop(columns=["us", "tie"]).reset_index(drop=True)
        out.insert(0, "line", key[0])
        out.insert(1, "station", key[1])
        out.insert(2, "ts", pd.to_datetime(us, unit="us"))
        for column in self.readings.columns:
            if column not in ("us", "tie"):
                out[column] = found[column].to_numpy()
        out["reading_us"] = pd.array(found["us"].to_numpy(), dtype="Int64")
        yield out

    def close(self) -> None:
        pass


def _time_join(
    events: DataFrame,
    readings: DataFrame,
    values: Sequence[str],
    mode: str,
    lateness_seconds: float | None,
    tie: str | None,
    reading_tie: str | None,
    salts: int,
    bucket_seconds: float,
) -> DataFrame:
    united, event_fields, value_fields = _united(events, readings, values, tie, reading_tie, salts)

    def ddl(fields: Sequence[T.StructField], prefix: str = "") -> str:
        return "".join(f", {prefix}{f.name} {_carried(f).dataType.simpleString()}" for f in fields)

    order = "us BIGINT, tie BIGINT"
    processor = TimeJoin(
        order + ddl(event_fields),
        order + ddl(value_fields, "r_"),
        mode,
        None if lateness_seconds is None else int(lateness_seconds * 1000),
        bucket_seconds,
    )
    output = (
        "line INT, station INT, ts TIMESTAMP" + ddl(event_fields) + ddl(value_fields, "r_") + ", reading_us BIGINT"
    )
    # Where an answer waits beyond its event's time, that time is no event time for what follows.
    joined = united.groupBy(*LINE_STATION, SALT).transformWithStateInPandas(
        processor, output, "append", "eventTime", eventTimeColumnName="" if mode == NEAREST else "ts"
    )
    return joined.select(
        *LINE_STATION,
        "ts",
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in event_fields],
        F.timestamp_micros("reading_us").alias("reading_ts"),
        *[F.col(f"r_{f.name}").cast(f.dataType).alias(f.name) for f in value_fields],
    )


def asof_join(
    events: DataFrame,
    readings: DataFrame,
    values: Sequence[str],
    tie: str | None = None,
    reading_tie: str | None = None,
    salts: int = SALTS,
    bucket_seconds: float = BUCKET_SECONDS,
) -> DataFrame:
    """Each event, once the watermark reaches it, with the latest reading at or before it (nulls if none).

    Both streams need a watermark on ``ts``; the join goes by the lower of the two. ``bucket_seconds`` is the width of the
    buckets that rows wait in: some hundred rows of a station and sub-key are a good size.
    """
    return _time_join(events, readings, values, BACKWARD, None, tie, reading_tie, salts, bucket_seconds)


def asof_join_with_lateness(
    events: DataFrame,
    readings: DataFrame,
    values: Sequence[str],
    bound_seconds: float,
    lateness_seconds: float,
    tie: str | None = None,
    reading_tie: str | None = None,
    salts: int = SALTS,
    bucket_seconds: float = BUCKET_SECONDS,
) -> DataFrame:
    """The as-of join with a grace period: an event up to ``lateness`` behind the on-time boundary is still matched.

    The watermarks are set here, to the disorder bound plus the lateness.
    """
    delay = f"{int((bound_seconds + lateness_seconds) * 1000)} milliseconds"
    return _time_join(
        events.withWatermark("ts", delay),
        readings.withWatermark("ts", delay),
        values,
        BACKWARD,
        lateness_seconds,
        tie,
        reading_tie,
        salts,
        bucket_seconds,
    )


def nearest_join(
    events: DataFrame,
    readings: DataFrame,
    values: Sequence[str],
    tie: str | None = None,
    reading_tie: str | None = None,
    salts: int = SALTS,
    bucket_seconds: float = BUCKET_SECONDS,
    certain: bool = False,
) -> DataFrame:
    """Each event with its nearest reading, and ``time_delta_ms``. Both streams need a watermark on ``ts``.

    The event is answered at once, from the readings that arrived in its micro-batch or before, or, if ``certain``, when no
    later reading can be nearer: then the result doesn't depend on how the input is cut. Of two equally close readings the
    earlier one wins; an event without a reading gives no row. Readings older than the latest one behind the watermark are
    dropped from the state.
    """
    mode = NEAREST if certain else ARRIVED
    joined = _time_join(events, readings, values, mode, None, tie, reading_tie, salts, bucket_seconds)
    delta = F.abs(F.unix_millis("ts") - F.unix_millis("reading_ts"))
    return joined.withColumn("time_delta_ms", delta)
