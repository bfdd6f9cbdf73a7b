"""Aggregates of one's own: partial results per task, merged as a tree.

Built-in functions come first; this is for what they and their compositions can't say. An ``Aggregate`` is to be commutative:
``add`` and ``merge`` may see rows and partial results in any order.
"""

from __future__ import annotations

import pickle
from abc import ABC, abstractmethod
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partial results of so many tasks meet on the first level of the tree.
FAN_IN = 256
# Keys a task holds before it passes their partial results on; more keys cost rows, not memory.
HELD_KEYS = 50_000


class Aggregate(ABC):
    """What happens to the rows of a key. Accumulators travel between tasks pickled; keep them small."""

    @abstractmethod
    def create(self) -> Any:
        """The accumulator of no rows."""

    @abstractmethod
    def add(self, accumulator: Any, rows: pa.RecordBatch) -> Any:
        """The accumulator with some rows of its key, which come as columns."""

    @abstractmethod
    def merge(self, one: Any, other: Any) -> Any:
        """The accumulator of both accumulators' rows."""

    @abstractmethod
    def result(self, accumulator: Any) -> dict[str, Any]:
        """Values by the names of the result's columns; a name that is missing is null."""


def by_key(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of each key of a batch; null is a key like others."""
    codes = np.zeros(batch.num_rows, dtype=np.int64)
    for name in keys:
        encoded = batch.column(name).dictionary_encode(null_encoding="encode")
        found, codes = np.unique(codes, return_inverse=True)
        codes = codes * max(len(encoded.dictionary), 1) + encoded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0]) if len(order) else order
    ordered = batch.take(pa.array(order))
    firsts = [ordered.column(name).take(pa.array(starts)).to_pylist() for name in keys]
    ends = np.r_[starts[1:], len(order)]
    for key, start, end in zip(zip(*firsts), starts, ends):
        yield key, ordered.slice(int(start), int(end - start))


def _rows(columns: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    by_column = zip(*rows) if rows else [[] for _ in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), type=kind) for (_, kind), values in zip(columns, by_column)], names=[n for n, _ in columns]
    )


def aggregate(rows: DataFrame, keys: list[str], function: Aggregate, result: str, held_keys: int = HELD_KEYS) -> DataFrame:
    """One row per key: the keys, then the columns of ``result`` (a schema in DDL).

    A task passes on one row per key it has seen (some more beyond ``held_keys`` keys), so a key with a large share of the
    rows sends no more than any other. Those rows are merged for ``FAN_IN`` tasks together, then for all. The merges read
    their rows as a stream. Null is a key, too; a table without rows has no keys.
    """
    fields = {f.name: f for f in rows.schema}
    if not keys:
        raise ValueError("an aggregate needs a key")
    if unknown := [k for k in keys if k not in fields]:
        raise ValueError(f"no such columns: {unknown}")
    names = [f"k{i}" for i in range(len(keys))]
    partial = T.StructType(
        [T.StructField(n, fields[k].dataType) for n, k in zip(names, keys)]
        + [T.StructField("part", T.IntegerType()), T.StructField("accumulator", T.BinaryType())]
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() // FAN_IN
        held: dict[tuple, Any] = {}
        types: list[pa.DataType] = []

        def passed_on() -> pa.RecordBatch:
            columns = [*zip(names, types), ("part", pa.int32()), ("accumulator", pa.binary())]
            return _rows(columns, [(*key, part, pickle.dumps(a)) for key, a in held.items()])

        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            for key, some in by_key(batch, keys):
                held[key] = function.add(held[key] if key in held else function.create(), some)
            if len(held) > held_keys:
                yield passed_on()
                held.clear()
        if held:
            yield passed_on()

    def merged(batches: Iterator[pa.RecordBatch]) -> tuple[pa.RecordBatch | None, Any]:
        accumulator, first = function.create(), None
        for batch in batches:
            first = first if first is not None or not batch.num_rows else batch.slice(0, 1)
            for pickled in batch.column("accumulator"):
                accumulator = function.merge(accumulator, pickle.loads(pickled.as_py()))
        return first, accumulator

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, accumulator = merged(batches)
        columns = [*(first.column(n) for n in [*names, "part"]), pa.array([pickle.dumps(accumulator)], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "part", "accumulator"])

    values = T.StructType.fromDDL(result)
    answer = T.StructType([*partial.fields[: len(keys)], *(T.StructField(f"v{i}", f.dataType) for i, f in enumerate(values))])
    value_types = _arrow_types(values)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, accumulator = merged(batches)
        found = function.result(accumulator)
        columns = [first.column(n) for n in names]
        columns += [pa.array([found.get(f.name)], type=kind) for f, kind in zip(values, value_types)]
        yield pa.RecordBatch.from_arrays(columns, names=answer.names)

    # Annotations of functions made here must be types, not text, for Spark to see that the groups come as streams.
    for step in (merge, finish):
        step.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    parts = rows.mapInArrow(add, partial).groupBy(*names, "part").applyInArrow(merge, partial)
    done = parts.groupBy(*names).applyInArrow(finish, answer)
    return done.select(
        *(F.col(n).alias(k) for n, k in zip(names, keys)), *(F.col(f"v{i}").alias(f.name) for i, f in enumerate(values))
    )


def _arrow_types(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema]


class Busy(Aggregate):
    """Time that lies within ``hold`` microseconds after some event, and the stretches it consists of.

    The accumulator is the stretches in order, so its size is bounded where the keys hold a window: one of a day has at most a
    day by ``hold`` of them.
    """

    def __init__(self, hold: int, column: str = "us") -> None:
        self.hold, self.column = hold, column

    def create(self) -> tuple[np.ndarray, np.ndarray]:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def add(self, accumulator, rows: pa.RecordBatch):
        starts = np.unique(rows.column(self.column).drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
        return self.merge(accumulator, (starts, starts + self.hold))

    def merge(self, one, other):
        starts, ends = np.r_[one[0], other[0]], np.r_[one[1], other[1]]
        if not len(starts):
            return self.create()
        order = np.lexsort((ends, starts))
        starts, reach = starts[order], np.maximum.accumulate(ends[order])
        opens = np.r_[True, starts[1:] > reach[:-1]]
        return starts[opens], reach[np.r_[opens[1:], True]]

    def result(self, accumulator) -> dict[str, int]:
        lengths = accumulator[1] - accumulator[0]
        return {"busy_us": int(lengths.sum()), "stretches": len(lengths), "longest_us": int(lengths.max(initial=0))}


def busy_time(events: DataFrame, keys: list[str], hold_seconds: float, width: str = "1 day") -> DataFrame:
    """Per key and window of event time: microseconds within ``hold_seconds`` after an event, in how many stretches, the longest.

    An event counts for its own window also where its hold reaches beyond it. Rows without time take no part.
    """
    timed = events.where(F.col("ts").isNotNull()).select(
        *keys, F.window("ts", width)["start"].alias("window_start"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    )
    schema = "busy_us BIGINT, stretches BIGINT, longest_us BIGINT"
    return aggregate(timed, [*keys, "window_start"], Busy(round(hold_seconds * 1_000_000)), schema)
