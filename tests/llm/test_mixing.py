from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Share by weight, set those above their most to it, share again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return {s: 2.0 * sizes[s] for s in names}
        level = (total - sum(2.0 * sizes[s] for s in full)) / sum(weights[s] for s in open_)
        above = [s for s in open_ if level * weights[s] > 2.0 * sizes[s]]
        if not above:
            return {s: 2.0 * sizes[s] if s in full else level * weights[s] for s in names}
        full |= set(above)


def check(docs, slack):
    rows = docs.select("doc_id", "source", "text").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    want = brute_targets(sizes)
    got = mixing.decide(docs.select("doc_id", "source", "text")).collect()
    assert Counter((r["id"], r["size"]) for r in got) == Counter((r["doc_id"], size(r["text"])) for r in rows)
    chosen = mixing.copies(docs.select("doc_id", "text", "source"))
    taken = defaultdict(int)
    for r in chosen.select("row.source", "size", "copies", "target", "source_size").collect():
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["size"] * r["copies"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= slack(source, target, rows), source
    return got


def test_documents(documents):
    half = lambda source, target, rows: max(size(r["text"]) for r in rows if r["source"] == source) / 2 + 1
    got = check(documents, half)
    again = mixing.decide(documents.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_odd_rows(odd, no_rows):
    check(odd, lambda source, target, rows: sum(size(r["text"]) for r in rows if r["source"] == source))
    assert mixing.decide(no_rows).count() == 0 and mixing.mix(no_rows).count() == 0


def test_many_small_documents_meet_their_targets(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "repeat('w ', cast(1 + id % 37 AS int)) AS text", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 's' || id % 8 END AS source"
    )
    check(docs, lambda source, target, rows: 1)


def test_mix_repeats_whole_rows(documents, odd):
    out = mixing.mix(documents)
    assert out.schema == documents.schema
    want = {r["id"]: r["taken"] // r["size"] for r in mixing.decide(documents).collect() if r["size"]}
    got = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert got == Counter({i: n for i, n in want.items() if n})
    mixed = mixing.mix(odd)
    assert mixed.schema == odd.schema
    want = sum(r["taken"] // r["size"] for r in mixing.decide(odd).collect() if r["size"])
    assert mixed.count() == len(mixed.collect()) == want


def test_importance_changes_the_odds(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a b c' AS text", "'s' || id % 3 AS source", "id % 2 AS good")
    chosen = mixing.copies(docs, importance=F.when(F.col("good") == 1, 1.6).otherwise(0.4)).where("row.source <> 's0'")
    by = {r["good"]: r["n"] for r in chosen.groupBy("row.good").agg(F.avg("copies").alias("n")).collect()}
    assert by[1] > by[0] + 0.2


def by_sql(docs, tmp_path):
    path = str(tmp_path / "documents")
    docs.select("doc_id", "source", "text").write.parquet(path)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
        return Counter(db.execute(f"SELECT doc_id, size, source_size, taken FROM ({mixing.SQL})").fetchall())


@pytest.mark.parametrize("same", [1, 2, 7, 1234])
def test_repeated_rows_are_taken_in_part(spark, tmp_path, same):
    """3,000 rows alike in id, source and words among 1,500 longer documents: targets are met to half a document."""
    docs = spark.range(4500, numPartitions=5).selectExpr(
        f"if(id < 3000, {same}, id) AS doc_id", "repeat('w ', if(id < 3000, 2, 10)) AS text", "'s' || id % 3 AS source"
    )
    got = check(docs, lambda source, target, rows: 5)
    assert Counter((r["id"], r["size"], r["source_size"], r["taken"]) for r in got) == by_sql(docs, tmp_path)
    mixed = mixing.mix(docs)
    want = sum(r["taken"] // r["size"] for r in got)
    assert mixed.count() == want


def test_one_repeated_row_is_the_whole_source(spark, tmp_path):
    docs = spark.range(999, numPartitions=4).selectExpr(
        "cast(if(id % 3 = 0, id, null) AS bigint) AS doc_id", "if(id % 3 = 2, 'a', 'a b c') AS text", "if(id % 3 = 0, null, 's' || id % 3) AS source"
    )
    got = check(docs, lambda source, target, rows: 2)
    assert Counter((r["id"], r["size"], r["source_size"], r["taken"]) for r in got) == by_sql(docs, tmp_path)


def test_a_large_group_is_numbered_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_BITS", 3)
    rows = spark.range(500, numPartitions=7).selectExpr("id % 2 AS sid", "1L AS id", "2L AS size")
    got = mixing._number(rows).groupBy("sid").agg(F.sort_array(F.collect_list("number")).alias("n")).collect()
    assert [r["n"] for r in got] == [list(range(1, 251))] * 2


def test_longer_documents_are_taken_more_often(spark):
    """Inclusion probabilities follow the bit length of the size, and are certain where they reach 1."""
    docs = spark.range(20000).selectExpr("id AS doc_id", "repeat('w ', if(id % 2 = 0, 1, 15)) AS text", "'s' || id % 3 AS source")
    chosen = mixing.copies(docs).where("row.source = 's1'").groupBy("size").agg(F.avg("copies").alias("n"), F.first("target").alias("t"))
    by = {r["size"]: r for r in chosen.collect()}
    n1, n15, count = by[1]["n"], by[15]["n"], 20000 / 6
    room = by[1]["t"] / count / 16
    if room < 1:
        scale = by[1]["t"] / count / (1 + 15 * 4)
        assert n1 == pytest.approx(scale, abs=0.03) and n15 == pytest.approx(4 * scale, abs=0.01)
    else:
        assert n15 > n1
