from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives, queries
from tests.llm.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50):
    """All pairs, in Python integers."""
    seen = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(v is None or not math.isfinite(v) for v in vector):
            continue
        row = (label, [math.floor(256 * v) for v in vector])
        seen[vec_id] = min(seen.get(vec_id, row), row)
    score = lambda a, b: sum(x * y for x, y in zip(seen[a][1], seen[b][1], strict=False))
    out = set()
    for a in seen:
        if a % every:
            continue
        scored = sorted((-score(a, b), b) for b in seen if b != a)
        positives = [(-s, b) for s, b in scored if seen[b][0] == seen[a][0]][:5]
        for p, b in positives:
            inside = [(-s, c) for s, c in scored if seen[c][0] != seen[a][0] and 50 * p <= -100 * s <= 95 * p][:3]
            out |= {(a, b, rank, c, p, s) for rank, (s, c) in enumerate(inside, 1)}
    return out


def shifted(rows):
    return [(i, v, (l + 1) % 10 if i is not None and l is not None and i % 7 == 0 else l) for i, v, l in rows]


def mined(df, **blocks):
    rows = hard_negatives.integers(df, F.col("label"))
    found = hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, **blocks).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.op12_hard_negatives(spark, SF)
    want = brute(shifted(rows))
    assert {tuple(r) for r in got.collect()} == want and want
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    cursor = duckdb.sql(hard_negatives.SQL)
    assert cursor.columns == got.columns and set(cursor.fetchall()) == want


@pytest.fixture(scope="module")
def mixed():
    """Clusters, many copies of one vector, ties, zero and opposite vectors, ragged lengths, values that are left out."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 70))
    rows = []
    for i in range(900):
        v = centres[i % 12] + rng.normal(size=70) * rng.choice([0.1, 1.0])
        v = np.round(v, 1) if i % 3 else v
        if i % 4 == 0:
            v = centres[0]
        if i % 90 == 0:
            v = v * 0
        if i % 130 == 0:
            v = -centres[0]
        rows.append((i, [float(np.float32(x)) for x in v[: 70 - (i % 5 == 0) * (i % 60)]], i % 4))
    rows += [(1000, [1.0], 99), (1050, [], 1), (1100, [2.0, None], 1), (1101, [float("nan")], 1), (1102, [float("-inf")], 1)]
    rows += [(None, [1.0], 1), (1150, None, 1), (1200, [1.0], None), (None, None, None), rows[50], rows[51], (50, [9.0] * 70, 0)]
    rows += [(-50, [0.5] * 70, 1), (-7, [0.25] * 70, 1)]
    return rows


def test_against_all_pairs(spark, mixed):
    df = spark.createDataFrame(mixed, SCHEMA).repartition(3)
    want = brute(mixed)
    assert mined(df) == want
    assert mined(df, rows_a_block=70, anchors_a_block=4) == want


def test_steps_of_few_rows(spark, mixed, monkeypatch):
    """Thresholds from earlier steps leave out only what can't come in."""
    rows = [(i, np.array(v), l) for i, v, l in mixed[:900]]
    x = np.zeros((len(rows), 128))
    for k, (_, v, _) in enumerate(rows):
        x[k, : len(v)] = np.floor(256 * v)
    codes, align = hard_negatives.coded(x)
    best = hard_negatives.Best(1, 5, np.array([hard_negatives.LOWEST]))
    q = hard_negatives.Queries(x[:1])
    for at in range(0, 900, 13):
        i, j, score = q.scores(np.array([0]), x[at : at + 13], np.ones((1, len(x[at : at + 13])), bool))
        best.add(i, score, np.arange(at, at + len(j)))
    order = sorted(range(900), key=lambda k: (-int(x[0] @ x[k]), k))[:5]
    assert best.id.tolist() == order


@pytest.mark.parametrize("width", [64, 256])
def test_intervals_hold_the_products(width):
    rng = np.random.default_rng(width)
    x = np.floor(rng.normal(size=(300, width)) * rng.choice([1, 50, 1000], (300, 1)))
    x[:3] = 0
    x[3:40] = x[5:42] * 3
    x[40, 1:] = 0
    codes, align = hard_negatives.coded(x)
    queries_ = hard_negatives.Queries(x[:120])
    low, high = queries_.interval(np.arange(120), codes, align)
    exact = x[:120] @ x.T
    assert (low <= exact).all() and (exact <= high).all()
    # The interval is worth having: far narrower than that of the lengths alone.
    lengths = np.linalg.norm(x, axis=1)
    whole = 2 * lengths[:120, None] * lengths
    assert np.median(((high - low) / np.maximum(whole, 1))[whole > 0]) < 0.25


def test_rotation_keeps_products():
    x = np.random.default_rng(0).normal(size=(20, 128))
    y = hard_negatives.turned(x)
    assert np.allclose(x @ x.T, y @ y.T) and not np.allclose(x, y)


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 2**19 for _ in range(5)], i % 2) for i in range(60)]
    rows = [(i, [float(np.float32(x)) for x in v], l) for i, v, l in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_no_rows_and_extra_columns(spark, mixed):
    df = spark.createDataFrame([(*r, 1, 2.0, "b") for r in mixed[:120]], SCHEMA + ", x int, score double, anchor string")
    assert mined(df) == brute(mixed[:120])
    assert mined(df.limit(0)) == set()
    assert mined(df.where("vec_id % 50 <> 0")) == set()


def test_only_new_groups_are_ordered_again(monkeypatch):
    """The time of a step must not grow with the anchors that were met before."""
    ordered = []
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: ordered.append(len(keys[0])) or lexsort(keys))
    rng = np.random.default_rng(3)
    best, all_ = hard_negatives.Best(500, 3, np.full(500, hard_negatives.LOWEST)), []
    for step in range(50):
        group = np.repeat(np.arange(step * 10, step * 10 + 10), 8)
        score, ids = rng.integers(0, 9, 80), rng.permutation(80) + 100 * step
        for half in (slice(0, 80, 2), slice(1, 80, 2)):
            best.add(group[half], score[half], ids[half])
        all_ += list(zip(group.tolist(), (-score).tolist(), ids.tolist(), strict=True))
    assert max(ordered) <= 40 + 30
    want = [r for g in range(500) for r in sorted(x for x in all_ if x[0] == g)[:3]]
    assert list(zip(best.group.tolist(), (-best.score).tolist(), best.id.tolist(), strict=True)) == want


@pytest.mark.parametrize("scale", [1, 2.0**30])
def test_reach_holds_the_products_in_either_precision(scale):
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(200, 128)) * 100) * scale
    x[0] = 0
    codes, align = hard_negatives.coded(x)
    block = hard_negatives.Queries(x[:50])
    opened, half = block.open(codes, align)
    for short in (block.short, None):
        block.short = short
        high = block.reach(np.arange(50), opened).astype(float) + hard_negatives.FREE
        low = high - 2 * (block.length[:50, None] * half + hard_negatives.FREE)
        exact = x[:50] @ x.T
        assert (low <= exact).all() and (exact <= high).all()
