from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa

from millrace.llm import exact_dedup


def brute(docs):
    groups = defaultdict(list)
    for row in docs.collect():
        groups[hashlib.sha256((row["text"] or "").encode().lower()).hexdigest()].append(row["doc_id"])
    out = Counter()
    for digest, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = max(known) if known else None
        left = 1
        for i in ids:
            stays = i == best and left == 1
            left -= stays
            out[i, best, len(ids), stays, digest] += 1
    return out


def check(docs):
    got = Counter(tuple(r) for r in exact_dedup.decide(docs).collect())
    assert got == brute(docs)


def test_documents(documents):
    check(documents)


def test_odd_rows(odd, no_rows):
    check(odd)
    check(no_rows)


def test_many_copies(spark):
    rows = [(i, "Hot" if i % 3 else f"text {i}") for i in range(4000)] + [(3998, "hOT")] * 40 + [(None, "hot")] * 50
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))


def test_rows_that_stay_are_whole(odd):
    kept = exact_dedup.drop_copies(odd)
    assert kept.schema == odd.schema
    want = Counter((i, d) for (i, _, _, stays, d), n in brute(odd).items() if stays for _ in range(n))
    got = Counter((r["doc_id"], hashlib.sha256((r["text"] or "").encode().lower()).hexdigest()) for r in kept.collect())
    assert got == want


def test_counters_find_every_frequent_digest(monkeypatch):
    monkeypatch.setattr(exact_dedup, "COUNTERS", 8)
    data = [b"a"] * 300 + [bytes([i % 250]) * 2 for i in range(1000)] + [b"b"] * 250
    batches = [pa.RecordBatch.from_arrays([pa.array(data[i : i + 100], pa.binary())], ["digest"]) for i in range(0, len(data), 100)]
    (out,) = exact_dedup._count_batches(iter(batches))
    counts = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True))
    assert counts.pop(None) == len(data) and len(counts) <= 8
    for key, n in ((b"a", 300), (b"b", 250)):
        assert n - len(data) / 9 <= counts[key] <= n
