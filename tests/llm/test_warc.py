from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter

import pytest

from millrace.llm import warc

TRAP = "aé\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx"


def brute(rows):
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    out = Counter()
    for html, ids in groups.items():
        data = html.encode()
        known = [i for i in ids if i is not None]
        first = min(known) if known else None
        for i in ids:
            kind = "response" if i == first else "revisit"
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            out[i, len(data), digest, kind, None if i == first else first] += 1
    return out


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", b"y") for r in rows], "page_id long, url string, html string, digest string, payload binary")


def test_odd_rows(spark):
    rows = [
        (5, "http://a/\r\nX: y", TRAP), (3, None, TRAP), (None, "u", None), (9, "u", ""), (3, None, TRAP), (None, None, "only"),
        (11, "q", "z" * 300_000), (-4, "é", "é\r\n\r\n"),
    ]
    got = Counter(map(tuple, warc.round_trip(pages(spark, rows)).collect()))
    assert got == brute(rows)
    assert warc.round_trip(pages(spark, rows).limit(0)).count() == 0


def test_many_revisits(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 50)
    rows = [(i, f"http://h/{i}", "same" if i % 3 else f"page {i % 40}") for i in range(400)]
    assert Counter(map(tuple, warc.round_trip(pages(spark, rows)).collect())) == brute(rows)


def test_small_payloads_are_responses(spark, tmp_path):
    rows = [(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long enough"), (4, "d", "long enough")]
    warc.write_archives(pages(spark, rows), str(tmp_path / "w"), min_bytes=5)
    kinds = Counter(r["type"] for r in warc.read_archives(spark, str(tmp_path / "w")).collect())
    assert kinds == {"request": 4, "response": 3, "revisit": 1, "metadata": 4}


def test_captures_are_nested(spark, tmp_path):
    rows = [(1, "http://h/1", TRAP), (2, "http://h/2", TRAP)]
    warc.write_archives(pages(spark, rows), str(tmp_path / "w"))
    got = {r["target_uri"]: r for r in warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).collect()}
    one, two = got["http://h/1"], got["http://h/2"]
    assert one["response"]["payload"].decode() == TRAP and two["response"]["payload"] is None
    assert two["response"]["payload_bytes"] == len(TRAP.encode()) and two["response"]["refers_to"] == one["record_id"]
    assert one["request"]["block"].startswith(b"GET http://h/1 HTTP/1.1\r\n") and b"pageId: 2" in two["metadata"]["block"]


def test_archives_are_standard_records(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "http://h/1", "é")]), str(tmp_path / "w"))
    data = b"".join(gzip.decompress(file.read_bytes()) for file in (tmp_path / "w").glob("part-*"))
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    records = list(warc.parse_records(data))
    assert [h["warc-type"] for h, _ in records] == ["request", "response", "metadata"]
    # Members compressed one by one are read, too.
    parts = b"".join(gzip.compress(p + b"\r\n\r\n") for p in data.split(b"\r\n\r\nWARC/")[:1])
    assert next(warc.parse_records(parts))[0]["warc-type"] == "request"
    with pytest.raises(ValueError):
        list(warc.parse_records(b"no archive"))
