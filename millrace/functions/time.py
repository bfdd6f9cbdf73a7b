"""Conversions between timestamps and epoch milliseconds (session zone UTC, see ``millrace.session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_millis(ts: str | Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(ts.cast("timestamp"))


def from_millis(millis: str | Column) -> Column:
    return F.timestamp_millis(millis)


def duration_ms(start: str | Column, end: str | Column) -> Column:
    """Difference of the two instants after each is cut to milliseconds."""
    return to_millis(end) - to_millis(start)


def seconds(amount: float) -> Column:
    """A constant interval; literal arithmetic is folded by the optimizer."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(amount)).cast("decimal(18,6)"))
