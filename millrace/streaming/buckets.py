"""Rows of one key held in event-time buckets, so that only those that are due are read again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessorHandle

BUCKET_SECONDS = 60


def _packed(rows: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False).replace_schema_metadata()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> pa.Table:
    return pa.ipc.open_stream(held).read_all()


class Buckets:
    """Frames with a column ``us`` (event time in microseconds), cut by time and kept in a map state.

    What arrives of a bucket in one go is one entry of the map, written as Arrow: one value that the state server passes on as
    it is, while arrays would be converted element by element, both ways. An index in a value state tells each entry's bucket and first
    and last time. Adding rows writes entries and reads none. Taking rows reads the entries that begin by then, and of these
    only one bucket can hold later rows, which are written back. So a micro-batch costs what arrives and what is due, however
    much waits; the index grows with the number of entries that wait, not with their rows.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, fields: str, width_us: int) -> None:
        """``fields`` is a schema of plain columns, ``us BIGINT`` among them."""
        columns = [field.split() for field in fields.split(",")]
        self.columns = [name for name, _ in columns]
        self.width_us = width_us
        self.entries = handle.getMapState(name, "bucket BIGINT, entry BIGINT", "rows BINARY")
        index = "bucket ARRAY<BIGINT>, entry ARRAY<BIGINT>, first_us ARRAY<BIGINT>, last_us ARRAY<BIGINT>"
        self.index_state = handle.getValueState(f"{name}Index", index)

    def load(self) -> None:
        """To be called before all else of an invocation: the processor's state is that of the current key."""
        held = self.index_state.get() if self.index_state.exists() else ([], [], [], [])
        self.index = [tuple(map(int, row)) for row in zip(*held, strict=True)]
        self.saved = list(self.index)

    def save(self) -> None:
        if self.index == self.saved:
            return
        if self.index:
            self.index_state.update(tuple(list(column) for column in zip(*self.index, strict=True)))
        else:
            self.index_state.clear()

    def add(self, rows: pd.DataFrame) -> None:
        if not len(rows):
            return
        us = rows["us"].to_numpy(dtype="int64")
        order = np.argsort(us, kind="stable")
        us, rows = us[order], rows.iloc[order]
        buckets = us // self.width_us
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(us)]
        number = max((entry for _, entry, _, _ in self.index), default=-1) + 1
        for begin, end in zip(cuts, cuts[1:], strict=False):
            key = (int(buckets[begin]), number)
            self.entries.updateValue(key, (_packed(rows.iloc[begin:end][self.columns]),))
            self.index.append((*key, int(us[begin]), int(us[end - 1])))
            number += 1

    def first(self) -> int | None:
        return min((first for _, _, first, _ in self.index), default=None)

    def _read(self, some: Sequence[tuple]) -> pd.DataFrame:
        if not some:
            return pd.DataFrame(columns=self.columns).astype({"us": "int64"})
        held = [_unpacked(self.entries.getValue((bucket, entry))[0]) for bucket, entry, _, _ in some]
        return pa.concat_tables(held, promote_options="permissive").to_pandas()

    def _remove(self, some: Sequence[tuple]) -> None:
        for bucket, entry, _, _ in some:
            self.entries.removeKey((bucket, entry))
        gone = set(some)
        self.index = [row for row in self.index if row not in gone]

    def take(self, upto_us: int) -> Iterator[pd.DataFrame]:
        """Remove the rows at or before ``upto_us`` and give them bucket by bucket."""
        due = [row for row in self.index if row[2] <= upto_us]
        for bucket in sorted({row[0] for row in due}):
            some = [row for row in due if row[0] == bucket]
            rows = self._read(some)
            self._remove(some)
            later = rows["us"] > upto_us
            self.add(rows[later])
            yield rows[~later]

    def around(self, from_us: int, to_us: int) -> pd.DataFrame:
        """The rows from the latest at or before ``from_us`` to the first after ``to_us``, and perhaps some beside them."""
        before = max((row[0] for row in self.index if row[2] <= from_us), default=None)
        after = min((row[0] for row in self.index if row[3] > to_us), default=None)
        low = before if before is not None else from_us // self.width_us
        high = after if after is not None else to_us // self.width_us
        return self._read([row for row in self.index if low <= row[0] <= high])

    def latest(self, upto_us: int) -> int | None:
        """The latest time at or before ``upto_us``."""
        some = [row for row in self.index if row[2] <= upto_us]
        if not some:
            return None
        bucket = max(row[0] for row in some)
        some = [row for row in some if row[0] == bucket]
        best = max((row[3] for row in some if row[3] <= upto_us), default=None)
        # An entry whose last row lies beyond must be looked into.
        for row in some:
            if row[3] > upto_us:
                us = self._read([row])["us"]
                inside = int(us[us <= upto_us].max())
                best = inside if best is None else max(best, inside)
        return best

    def next(self, after_us: int) -> int | None:
        """A time after ``after_us`` before which no row after ``after_us`` lies."""
        return min((max(row[2], after_us + 1) for row in self.index if row[3] > after_us), default=None)

    def forget(self, upto_us: int) -> None:
        """Drop the buckets before the one with the latest row at or before ``upto_us``."""
        newest = max((row[0] for row in self.index if row[2] <= upto_us), default=None)
        if newest is not None:
            self._remove([row for row in self.index if row[0] < newest])
