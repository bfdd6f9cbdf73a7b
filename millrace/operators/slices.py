"""Ordered per-key computations that stay parallel when one key holds a large share of the rows.

A plain ``Window.partitionBy(key).orderBy(...)`` puts a whole key into one task. Here a key with more rows than
``rows_per_slice`` is cut into consecutive slices of its order, the window runs per (key, slice), and what each slice
owes to the slices before (or after) it comes from a small table with one row per slice:

1. ``find_cuts`` samples the order columns and keeps every n-th sample point of each large key. The sample only
   chooses boundaries; every row takes part in the result, and the result does not depend on the boundaries.
2. ``scan`` runs the window inside the slices, aggregates each slice once (with map-side partial aggregation), folds
   these totals over the slices of a key and joins them back.

Where no key is large, ``find_cuts`` returns None and ``scan`` is the plain window with one exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.session import PARTITIONS, shared_folder

# What a task sorts is some slices; at half a kB a row for two sorts, 250,000 rows are 125 MB.
ROWS_PER_SLICE = 250_000
SAMPLES_PER_SLICE = 16
# A table of this many short rows is some tens of MB; above it the joins are left to shuffle.
MAX_BROADCAST_ROWS = 500_000

SLICE = "_slice"
CUTS = "_cuts"


@dataclass(frozen=True)
class Cuts:
    """Slice boundaries of the large keys: one row per key with a sorted array of order values."""

    table: DataFrame
    longest: int
    total: int

    def small(self, rows: DataFrame) -> DataFrame:
        """Broadcast a table with at most one row per slice when the number of slices allows it."""
        return F.broadcast(rows) if self.total <= MAX_BROADCAST_ROWS else rows


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int | None = ROWS_PER_SLICE
) -> Cuts | None:
    """Look for keys with more than about two slices of rows; None where there are none.

    Reads only the key and order columns and shuffles one sample row per ``rows_per_slice / 16`` input rows, so the
    sample of a key, and the boundaries, are bounded by its row count over that number.
    """
    if rows_per_slice is None:
        return None
    per_slice = min(SAMPLES_PER_SLICE, rows_per_slice)
    sample = df.select(*keys, *order)
    if rows_per_slice > per_slice:
        sample = sample.sample(fraction=per_slice / rows_per_slice, seed=7)
    enough = 2 * per_slice + 1
    if len(sample.take(enough)) < enough:
        # Not even all keys together are large. Without a shuffle, and on a large input after its first partitions.
        return None
    points = (
        sample.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias(CUTS))
        .where(F.size(CUTS) > 2 * per_slice)
        .select(*keys, F.filter(CUTS, lambda _, i: i % per_slice == per_slice - 1).alias(CUTS))
    )
    # Fixed once, before it is looked at: both passes of a scan must see the same boundaries, also after an executor is lost.
    shared_folder(df.sparkSession)
    points = points.checkpoint()
    if points.isEmpty():
        return None
    longest, total = points.agg(F.max(F.size(CUTS)), F.sum(F.size(CUTS) + 1)).first()
    return Cuts(points, longest, total)


def _lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be null.

    A plain equality would also infer not-null filters for one pass over the rows only, and the two passes could not
    share the exchanges below them.
    """
    renamed = table.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return rows.join(renamed, same, how).drop(*[f"_key_{k}" for k in keys])


def with_slice(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts, only_cut_keys: bool = False
) -> DataFrame:
    """Add ``_slice``: how many boundaries of the row's key are at or before the row (0 for a key without cuts).

    A binary search by halving steps, one projection per step: as a chain of projections it is compiled, which a
    higher-order function over the array is not. ``_slice`` is never null and is not to be filtered on: such a
    predicate would be pushed through the chain and double at every step.
    """
    here = F.struct(*order)
    found = F.col(SLICE)
    rows = _lookup(df, cuts.small(cuts.table), keys, "inner" if only_cut_keys else "left")
    rows = rows.withColumn(SLICE, F.lit(0))
    for bit in reversed(range(cuts.longest.bit_length())):
        step = 1 << bit
        # F.get is null past the end of the array.
        passed = F.get(CUTS, found + step - 1) <= here
        rows = rows.withColumn(SLICE, found + F.when(passed, step).otherwise(0))
    return rows.drop(CUTS)


@dataclass(frozen=True)
class Fold:
    """One running value: inside a slice, of a whole slice, over slices, and the two put together.

    ``local`` gets the ordered window of the part and ``carry`` the name of the total and the ordered window over a
    key's slices. Rows where ``relevant`` is null do not change the total.
    """

    name: str
    local: Callable[[WindowSpec], Column]
    total: Column
    carry: Callable[[str, WindowSpec], Column]
    merge: Callable[[Column, Column], Column]
    relevant: Column
    backward: bool = False


def _up_to_here(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _running(name: str, aggregate: Callable, value: Column, carry: Callable, merge: Callable) -> Fold:
    return Fold(
        name,
        lambda w: aggregate(value).over(_up_to_here(w)),
        aggregate(value),
        lambda total, w: carry(total).over(_before(w)),
        merge,
        value,
    )


def _plus(carried: Column, local: Column) -> Column:
    return F.coalesce(carried + local, carried, local)


def running_count(name: str, value: Column | None = None) -> Fold:
    """Rows so far (or rows so far where ``value`` is not null)."""
    return _running(name, F.count, F.lit(1) if value is None else value, F.sum, _plus)


def running_sum(name: str, value: Column) -> Fold:
    return _running(name, F.sum, value, F.sum, _plus)


def running_min(name: str, value: Column) -> Fold:
    return _running(name, F.min, value, F.min, F.least)


def running_max(name: str, value: Column) -> Fold:
    return _running(name, F.max, value, F.max, F.greatest)


def max_before(name: str, value: Column) -> Fold:
    """Highest ``value`` among the rows before this one."""
    return Fold(
        name,
        lambda w: F.max(value).over(_before(w)),
        F.max(value),
        lambda total, w: F.max(total).over(_before(w)),
        F.greatest,
        value,
    )


def last_known(name: str, value: Column, order: Sequence[str]) -> Fold:
    """Latest non-null ``value`` at or before the row."""
    return Fold(
        name,
        lambda w: F.last(value, ignorenulls=True).over(_up_to_here(w)),
        F.max_by(value, F.when(value.isNotNull(), F.struct(*order))),
        lambda total, w: F.last(total, ignorenulls=True).over(_before(w)),
        lambda carried, local: F.coalesce(local, carried),
        value,
    )


def next_known(name: str, value: Column, order: Sequence[str]) -> Fold:
    """Earliest non-null ``value`` at or after the row.

    Runs over the descending order: a frame that ends at unbounded following is quadratic in Spark.
    """
    return Fold(
        name,
        lambda w: F.last(value, ignorenulls=True).over(_up_to_here(w)),
        F.min_by(value, F.when(value.isNotNull(), F.struct(*order))),
        lambda total, w: F.last(total, ignorenulls=True).over(_before(w)),
        lambda carried, local: F.coalesce(local, carried),
        value,
        backward=True,
    )


def previous_row(name: str, value: Column, order: Sequence[str]) -> Fold:
    """``value`` (not null) of the row before this one."""
    return Fold(
        name,
        lambda w: F.lag(value).over(w),
        F.max_by(value, F.struct(*order)),
        lambda total, w: F.lag(total).over(w),
        lambda carried, local: F.coalesce(local, carried),
        value,
    )


def next_row(name: str, column: str, order: Sequence[str]) -> Fold:
    """``column`` (not null) of the row after this one."""
    value = F.col(column)
    # The smallest value of the leading order column is that of the first row; a plain minimum needs no sort.
    first = F.min(value) if column == order[0] else F.min_by(value, F.struct(*order))
    return Fold(
        name,
        lambda w: F.lead(value).over(w),
        first,
        lambda total, w: F.lead(total).over(w),
        lambda carried, local: F.coalesce(local, carried),
        value,
    )


def scan(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], folds: Sequence[Fold], cuts: Cuts | None
) -> DataFrame:
    """``df`` with one column per fold, computed over each key's rows in ``order``."""
    rows, part = df, [*keys]
    if cuts is not None:
        # At least a partition per slice, however few the session's setting gives; they are not merged again.
        part = [*keys, SLICE]
        partitions = max(cuts.total, int(df.sparkSession.conf.get(PARTITIONS)))
        rows = with_slice(df, keys, order, cuts).repartition(partitions, *part)
    ascending = Window.partitionBy(*part).orderBy(*order)
    descending = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
    local = rows.select("*", *[f.local(descending if f.backward else ascending).alias(f.name) for f in folds])
    if cuts is None:
        return local

    # Only rows of cut keys have a slice before or after them. One row per slice from here on.
    relevant = reduce(or_, [f.relevant.isNotNull() for f in folds])
    totals = (
        with_slice(df.where(relevant), keys, order, cuts, only_cut_keys=True)
        .groupBy(*part)
        .agg(*[f.total.alias(f"_total_{f.name}") for f in folds])
    )
    # A slice without such rows still has slices around it.
    every = cuts.table.select(*keys, F.explode(F.sequence(F.lit(0), F.size(CUTS))).alias(SLICE))
    totals = _lookup(every, cuts.small(totals), part, "left")
    upward = Window.partitionBy(*keys).orderBy(SLICE)
    downward = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc())
    carried = totals.select(
        *part,
        *[f.carry(f"_total_{f.name}", downward if f.backward else upward).alias(f"_carry_{f.name}") for f in folds],
    )
    joined = _lookup(local, cuts.small(carried), part, "left")
    return joined.select(
        *[c for c in df.columns],
        *[f.merge(F.col(f"_carry_{f.name}"), F.col(f.name)).alias(f.name) for f in folds],
    )
