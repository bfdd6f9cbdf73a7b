"""State per visit and per unit: pairing of IN and OUT, and totals. A few rows per key, handled row by row."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.schemas import IN, STATION_PROCESSING_EVENT, UNIT_SUMMARY, VISIT
from millrace.streaming.stations import reset_timer


class Pairing(StatefulProcessor):
    """Holds events without a partner; the oldest one is paired with the next event of the other action.

    With ``orphan_ms`` an event is forgotten when the watermark is that far past it.
    """

    def __init__(self, orphan_ms: int | None = None) -> None:
        self.orphan_ms = orphan_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "action STRING, ts TIMESTAMP, energy DOUBLE")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # All that wait have the same action, or they would have been paired.
        held = self._held()
        waiting = list(held)
        line, station, unit = key
        for row in sorted(rows, key=lambda r: r.ts):
            if not waiting or waiting[0].action == row.action:
                waiting.append(Row(action=row.action, ts=row.ts, energy=row.energy))
                continue
            partner = waiting.pop(0)
            start, end = (partner, row) if partner.action == IN else (row, partner)
            used = None if start.energy is None or end.energy is None else end.energy - start.energy
            yield Row(
                line=line, station=station, unit_id=unit, start_ts=start.ts, end_ts=end.ts, energy_consumption=used
            )
        self._hold(held, waiting)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        watermark = timerValues.getCurrentWatermarkInMs()
        self._hold(held, [w for w in held if self._due(w) > watermark])
        return iter([])

    def _held(self) -> list[Row]:
        if not self.waiting.exists():
            return []
        return [Row(action=action, ts=ts, energy=energy) for action, ts, energy in self.waiting.get()]

    def _due(self, event: Row) -> int:
        return math.ceil(event.ts.timestamp() * 1000) + self.orphan_ms

    def _hold(self, held: list[Row], waiting: list[Row]) -> None:
        if waiting == held:
            return
        if waiting:
            self.waiting.put([(w.action, w.ts, w.energy) for w in waiting])
        else:
            self.waiting.clear()
        if self.orphan_ms is not None:
            reset_timer(self.handle, min(map(self._due, waiting), default=None))

    def close(self) -> None:
        pass


def pair_in_out(events: DataFrame, energy: str | None = None, orphan_seconds: int | None = None) -> DataFrame:
    """Visits as soon as both events are there.

    ``orphan_seconds`` bounds the state: an event without partner is forgotten when the watermark (which ``events``
    then needs) is that far past it.
    """
    meter = F.lit(None).cast("double") if energy is None else F.col(energy)
    rows = events.select(*VISIT, "ts", "action", meter.alias("energy"))
    return rows.groupBy(*VISIT).transformWithState(
        Pairing(None if orphan_seconds is None else orphan_seconds * 1000),
        STATION_PROCESSING_EVENT,
        "append",
        "none" if orphan_seconds is None else "eventTime",
    )


class UnitTotal(StatefulProcessor):
    """Adds up visits and reports at every ``stations``-th one."""

    def __init__(self, stations: int) -> None:
        self.stations = stations

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "visits INT, energy DOUBLE")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.total.exists()
        visits, energy = self.total.get() if known else (0, 0.0)
        for row in sorted(rows, key=lambda r: r.end_ts):
            visits += 1
            energy += row.energy_consumption or 0.0
            if visits == self.stations:
                yield Row(unit_id=key[0], line=row.line, energy_consumption=energy)
                visits, energy = 0, 0.0
        if visits:
            self.total.update((visits, energy))
        elif known:
            self.total.clear()

    def close(self) -> None:
        pass


def sum_per_unit(visits: DataFrame, stations: int) -> DataFrame:
    """Energy of every ``stations`` visits of a unit, in order of arrival (of time within a micro-batch)."""
    rows = visits.select("unit_id", F.col("line").cast("bigint").alias("line"), "end_ts", "energy_consumption")
    return rows.groupBy("unit_id").transformWithState(UnitTotal(stations), UNIT_SUMMARY, "append", "none")
