"""Sliced scans give the same rows as one pass over each key, whatever the skew and the slice size."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import slices

KEYS, ORDER = ["k"], ["t", "id"]


def skewed_rows(n: int = 900) -> list[tuple]:
    """A third of the rows in one key, a third of those at one instant."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.choice([1, rng.randrange(1, 30)])
        t = 500 if i % 9 == 0 else rng.randrange(1000)
        rows.append((key, t, i, float(rng.randrange(100)) if rng.random() < 0.5 else None))
    rng.shuffle(rows)
    # The second largest key is missing.
    return [(None if key == 1 else key, *rest) for key, *rest in rows]


def folds():
    value = F.col("v")
    return [
        slices.running_count("n"),
        slices.running_sum("s", value),
        slices.running_min("lo", value),
        slices.running_max("hi", value),
        slices.max_before("hi_before", value),
        slices.last_known("last_v", value, ORDER),
        slices.next_known("next_v", value, ORDER),
        slices.previous_row("prev_id", F.col("id"), ORDER),
        slices.next_row("next_id", "id", ORDER),
        slices.next_row("next_t", "t", ORDER),
    ]


def brute_force(rows: list[tuple]) -> dict[int, tuple]:
    out = {}
    by_key: dict[int, list[tuple]] = {}
    for row in rows:
        by_key.setdefault(row[0], []).append(row)
    for group in by_key.values():
        group.sort(key=lambda r: (r[1], r[2]))
        values = [r[3] for r in group]
        for i, row in enumerate(group):
            seen = [v for v in values[: i + 1] if v is not None]
            before = [v for v in values[:i] if v is not None]
            ahead = [v for v in values[i:] if v is not None]
            out[row[2]] = (
                i + 1,
                sum(seen) if seen else None,
                min(seen, default=None),
                max(seen, default=None),
                max(before, default=None),
                seen[-1] if seen else None,
                ahead[0] if ahead else None,
                group[i - 1][2] if i else None,
                group[i + 1][2] if i + 1 < len(group) else None,
                group[i + 1][1] if i + 1 < len(group) else None,
            )
    return out


@pytest.mark.parametrize("rows_per_slice", [None, 3, 20, 64, 100_000])
def test_scan_equals_brute_force(spark, rows_per_slice):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k INT, t INT, id INT, v DOUBLE")
    cuts = slices.find_cuts(df, KEYS, ORDER, rows_per_slice)
    assert (cuts is None) == (rows_per_slice in (None, 100_000))
    got = slices.scan(df, KEYS, ORDER, folds(), cuts)
    names = ["n", "s", "lo", "hi", "hi_before", "last_v", "next_v", "prev_id", "next_id", "next_t"]
    assert got.columns == ["k", "t", "id", "v", *names]
    assert {r["id"]: tuple(r[c] for c in names) for r in got.collect()} == brute_force(rows)


@pytest.mark.parametrize("index", range(10))
def test_each_fold_alone(spark, index):
    """Slices without a value of their own still get what the slices before and after them hold."""
    rows = [(0, i, i, 1.0 * i if i in (3, 90) else None) for i in range(100)]
    df = spark.createDataFrame(rows, "k INT, t INT, id INT, v DOUBLE")
    cuts = slices.find_cuts(df, KEYS, ORDER, 5)
    fold = folds()[index]
    got = slices.scan(df, KEYS, ORDER, [fold], cuts)
    assert {r["id"]: r[fold.name] for r in got.collect()} == {i: v[index] for i, v in brute_force(rows).items()}


def test_slices_of_the_hot_key_are_small(spark):
    df = spark.createDataFrame(skewed_rows(), "k INT, t INT, id INT, v DOUBLE")
    cuts = slices.find_cuts(df, KEYS, ORDER, 20)
    sliced = slices.with_slice(df, KEYS, ORDER, cuts)
    sizes = sliced.groupBy("k", slices.SLICE).count().toPandas()
    hot = sizes[sizes.k == 0]
    assert hot["count"].sum() == 300
    # Sampling makes slices uneven, by a few times at most. The tied instant is split, too.
    assert hot["count"].max() <= 80
    assert len(hot) >= 8
    assert (sizes[sizes.k != 0].groupby("k").size() <= 3).all()


def test_slices_follow_the_order(spark):
    df = spark.createDataFrame(skewed_rows(), "k INT, t INT, id INT, v DOUBLE")
    cuts = slices.find_cuts(df, KEYS, ORDER, 10)
    sliced = slices.with_slice(df, KEYS, ORDER, cuts)
    rows: pd.DataFrame = sliced.toPandas().sort_values(["k", "t", "id"])
    assert rows.groupby("k")[slices.SLICE].apply(lambda s: s.is_monotonic_increasing).all()


def test_the_search_stays_a_chain(spark):
    """One comparison per step and pass, also after the optimizer; nested, it would be 2 ** steps of them."""
    df = spark.createDataFrame([(0, i, i, 1.0) for i in range(2000)], "k INT, t INT, id INT, v DOUBLE")
    cuts = slices.find_cuts(df, KEYS, ORDER, 1)
    steps = cuts.longest.bit_length()
    assert steps >= 10
    got = slices.scan(df, KEYS, ORDER, folds(), cuts)
    assert got._jdf.queryExecution().executedPlan().toString().count("_cuts#") < 20 * steps
    assert got.where("n = 2000").select("id", "prev_id").collect() == [(1999, 1998)]


def test_large_cut_tables_are_not_broadcast(spark, monkeypatch):
    df = spark.createDataFrame(skewed_rows(), "k INT, t INT, id INT, v DOUBLE")
    cuts = slices.find_cuts(df, KEYS, ORDER, 10)
    monkeypatch.setattr(slices, "MAX_BROADCAST_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = slices.scan(df, KEYS, ORDER, folds()[:1], cuts)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert {r["id"]: r["n"] for r in got.collect()} == {i: v[0] for i, v in brute_force(skewed_rows()).items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_key_of_a_million_rows_is_no_task_of_its_own(spark):
    """With the session's two partitions, too: what a task sorts doesn't grow with a key."""
    rows = spark.range(1_200_000).select(F.lit(1).alias("k"), F.col("id").alias("t"), "id")
    cuts = slices.find_cuts(rows, KEYS, ORDER)
    counted = slices.scan(rows, KEYS, ORDER, [slices.running_count("n")], cuts)
    assert counted.where("n <> id + 1").isEmpty()
    # A count alone would drop the window, and with it the exchange.
    tasks = counted.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("rows"), F.max("n").alias("n")).toPandas()
    sizes = tasks["rows"]
    assert sizes.sum() == 1_200_000
    assert sizes.max() <= 800_000
