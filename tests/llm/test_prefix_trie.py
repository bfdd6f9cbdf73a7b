from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from millrace.llm import prefix_trie, queries
from tests.llm.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, heads=6, share=100, lead=True):
    """The trie as dictionaries of tuples."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, sha), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    whole = dict(own)
    if lead:
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % heads
            base = c - (abs(c) % share) * (1 if c >= 0 else -1)
            whole[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = {}, {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    children = {}
    for key in members:
        if key:
            children[key[:-1]] = children.get(key[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for key, convs in members.items():
        value = (len(convs) - 1) * (len(key[-1][1]) if key else 0)
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children.get(key)
            saved[key[:d]] += value
    return {
        (min(m), len(k)): (
            min(members[k[:-1]]) if k else None, len(m), children.get(k, 0), leaves[k], saved[k],
            hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest(),
        )
        for k, m in members.items()
    }


def found(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert found(queries.op13_prefix_trie(spark, SF)) == brute(rows)
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    cursor = duckdb.sql(prefix_trie.SQL)
    assert cursor.columns == queries.op13_prefix_trie(spark, SF).columns
    assert {r[:2]: r[2:] for r in cursor.fetchall()} == brute(rows)


@pytest.fixture(scope="module")
def crowded():
    """Few texts, so that many prefixes are shared; nulls, repeats, ties, a very long conversation and its near copies."""
    rng = random.Random(11)
    rows = []
    for conv in [*range(-30, 260), 5000, 5001]:
        for turn in range(rng.randint(0, 7)):
            number = rng.choice([turn, turn, turn, None, 0])
            rows.append((conv, number, rng.choice(["user", "user", None, ""]), rng.choice(["a", "bb", "", None, "é🙂"])))
    rows += rows[:40] + [(None, 1, "user", "a"), (None, None, None, None)]
    for conv, until in ((700, 300), (717, 300), (723, 150), (790, 290)):
        rows += [(conv, i, "user", "x" * (i % 5) if i < until else f"own {conv}") for i in range(300)]
    return rows


def test_whole_and_in_small_parts(spark, crowded):
    """Slices, shards and segments of few rows: the long conversation lies in many of each."""
    df = spark.createDataFrame(crowded, SCHEMA).repartition(5)
    for slices, shard, segment in ((None, 10**6, 10**6), (20, 50, 7)):
        paths = prefix_trie.rebuilt(prefix_trie.turns(df, slices))
        assert found(prefix_trie.nodes(paths, slices, shard, segment)) == brute(crowded)


def test_conversations_as_they_are(spark, crowded):
    paths = prefix_trie.plain(prefix_trie.turns(spark.createDataFrame(crowded, SCHEMA)))
    assert found(prefix_trie.nodes(paths, segment=16)) == brute(crowded, lead=False)


def test_many_equal_conversations(spark, monkeypatch):
    """Members of one node far beyond a run of ids."""
    monkeypatch.setattr(prefix_trie, "RUN", 64)
    rows = [(c, t, "user", f"t{t}") for c in range(-500, 3000) for t in range(2)]
    paths = prefix_trie.plain(prefix_trie.turns(spark.createDataFrame(rows, SCHEMA)))
    assert found(prefix_trie.nodes(paths)) == brute(rows, lead=False)


def test_no_rows_and_extra_columns(spark, crowded):
    df = spark.createDataFrame([(*r, 1, b"", 2) for r in crowded[:50]], SCHEMA + ", depth long, first binary, g1 int")
    trie = lambda df: found(prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.turns(df))))
    assert trie(df) == brute(crowded[:50])
    assert trie(df.limit(0)) == {}
    assert trie(df.where("conv_id IS NULL")) == {}


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = rng.integers(-(2**63), 2**63 - 1, (2 * n, 2))
        a, b = keys[:n, 0].copy(), keys[:n, 1].copy()
        b[: n // 2] = 7  # half of them differ in one number only
        table = prefix_trie.SlotTable(a, b)
        assert sorted(table(a, b)) == list(range(n))
        assert (table(keys[n:, 0].copy(), keys[n:, 1].copy()) == -1).all()


def test_one_digest_for_two_prefixes_is_refused():
    import pyarrow as pa

    row = {"conv_id": [1, 2], "depth": [1, 1], "g1": [5, 5], "g2": [6, 6], "p1": [0, 0], "p2": [0, 0], "n_chars": [1, 1]}
    with pytest.raises(ValueError):
        prefix_trie._count_shard(pa.table(row | {"turn": [b"a", b"b"]}))
