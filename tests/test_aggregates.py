"""Aggregates of one's own: partial results, the merge tree, and busy time against brute force."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import aggregates
from millrace.operators.aggregates import Aggregate, Busy
from tests.conftest import at


class Extremes(Aggregate):
    """Number, least and greatest value, and how many accumulators were merged into the result."""

    def create(self):
        return 0, None, None, 0

    def add(self, accumulator, rows):
        values = [v for v in rows.column("v").to_pylist() if v is not None]
        return self.merge(accumulator, (rows.num_rows, min(values, default=None), max(values, default=None), 0))

    def merge(self, one, other):
        low = [x for x in (one[1], other[1]) if x is not None]
        high = [x for x in (one[2], other[2]) if x is not None]
        return one[0] + other[0], min(low, default=None), max(high, default=None), one[3] + other[3]

    def result(self, accumulator):
        return dict(zip(["n", "low", "high"], accumulator))


SCHEMA = "n BIGINT, low BIGINT, high BIGINT, missing STRING"


def test_keys_nulls_and_clashing_names(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5), ("a", None, 7), (None, 1, 2), (None, 1, None), ("a", 1, -3), ("", 1, None)],
        "part STRING, accumulator INT, v BIGINT",
    )
    got = aggregates.aggregate(rows, ["part", "accumulator"], Extremes(), SCHEMA)
    assert got.columns == ["part", "accumulator", "n", "low", "high", "missing"]
    assert {tuple(r) for r in got.collect()} == {
        ("a", 1, 2, -3, 5, None), ("a", None, 1, 7, 7, None), (None, 1, 2, 2, 2, None), ("", 1, 1, None, None, None)
    }


def test_no_rows(spark):
    rows = spark.createDataFrame([], "k INT, v BIGINT")
    assert aggregates.aggregate(rows, ["k"], Extremes(), SCHEMA).collect() == []


def test_unknown_or_no_keys(spark):
    rows = spark.createDataFrame([], "k INT, v BIGINT")
    for keys in (["x"], []):
        with pytest.raises(ValueError):
            aggregates.aggregate(rows, keys, Extremes(), SCHEMA)


@pytest.mark.parametrize("held", [1, 7, 50_000])
def test_a_key_with_most_rows_over_many_tasks(spark, monkeypatch, held):
    monkeypatch.setattr(aggregates, "FAN_IN", 4)
    key = F.when(F.col("id") % 3 < 2, -1).otherwise(F.col("id") % 50)
    rows = spark.range(0, 30_000, 1, 13).select(key.alias("k"), F.col("id").alias("v"))
    got = aggregates.aggregate(rows, ["k"], Extremes(), SCHEMA, held_keys=held).drop("missing")
    want = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_what_is_shuffled_is_partial(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = aggregates.aggregate(rows, ["k"], Extremes(), SCHEMA)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange") :]
    assert "MapInArrow" in below and plan.count("Exchange") == 2 and "SinglePartition" not in plan


def test_rows_of_a_batch_by_key():
    batch = pa.RecordBatch.from_pydict({"a": ["x", None, "x", "y"], "b": [1, 1, 1, None], "v": [1, 2, 3, 4]})
    got = {key: rows.column("v").to_pylist() for key, rows in aggregates.by_key(batch, ["a", "b"])}
    assert got == {("x", 1): [1, 3], (None, 1): [2], ("y", None): [4]}
    assert list(aggregates.by_key(batch.slice(0, 0), ["a"])) == []


times = st.lists(st.integers(0, 300), max_size=40)


@given(times, times, st.integers(1, 30))
def test_busy_time_is_the_same_however_it_is_merged(left, right, hold):
    busy = Busy(hold)
    parts = [busy.add(busy.create(), pa.RecordBatch.from_pydict({"us": pa.array(t, pa.int64())})) for t in (left, right)]
    got = busy.result(busy.merge(*parts))
    assert got == busy.result(busy.merge(*reversed(parts)))
    covered = np.zeros(400, dtype=bool)
    starts = sorted({*left, *right})
    for t in starts:
        covered[t : t + hold] = True
    # Stretches that just touch are one.
    stretches = [[t] for i, t in enumerate(starts) if i == 0 or t - starts[i - 1] > hold]
    assert got["busy_us"] == covered.sum() and got["stretches"] == len(stretches)


def test_busy_time_by_window(spark):
    noon = at("2026-01-30 12:00:00")
    events = [(0, noon), (0, noon + timedelta(seconds=10)), (0, noon), (0, noon + timedelta(seconds=90)), (1, None),
              (None, noon + timedelta(hours=13))]
    rows = spark.createDataFrame(events, "line INT, ts TIMESTAMP_NTZ")
    got = {(r.line, r.window_start): (r.busy_us, r.stretches, r.longest_us) for r in aggregates.busy_time(rows, ["line"], 30).collect()}
    assert got == {
        (0, at("2026-01-30 00:00:00")): (70_000_000, 2, 40_000_000),
        (None, at("2026-01-31 00:00:00")): (30_000_000, 1, 30_000_000),
    }
