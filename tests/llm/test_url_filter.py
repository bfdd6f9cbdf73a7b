from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.llm import url_filter


def brute(url):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:end].translate({65 + i: 97 + i for i in range(26)})
        path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for verdict, rule in url_filter.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (not best or len(rule) > len(best[1])):
            best = (verdict, rule)
    listed = any(label in url_filter.LISTED_LABELS for label in host.split("."))
    return host, path, best and best[1], listed, best[0] if best else "block" if listed else "allow"


ODD = [
    None, "", "no scheme", "://", "http://", "http://NET/", "http://net", "http://a.net/x?y://z", "https://Ex.Example.NET/en/1#/de/",
    "http://example.net/en", "http://example.com/de/?x", "http://xexample.com/de/", "ftp://spam-farm.example.org/fr/", "x://a.org/fr/\n/q?",
    "http://a..b/", "http://.casino-win/", "http://ÀÉ.org/fr/", "http://user@adult-x.com:80/", "http://example.com?/de/", "http://cheap-pills",
    "http://" + "a." * 3000 + "free-bets.org/" + "p" * 100_000,
]


@pytest.mark.parametrize("max_bits", [url_filter.MAX_FILTER_BITS, 1])
def test_odd_urls(spark, max_bits):
    rows = [(i, u, "x", True) for i, u in enumerate(ODD)] + [(None, "http://net/", "x", False), (1, "", "y", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, listed boolean")
    got = url_filter.judge(pages, max_bits=max_bits).collect()
    want = sorted([(i, *brute(u)) for i, u, _, _ in rows], key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    assert url_filter.judge(pages.limit(0), max_bits=max_bits).count() == 0


@pytest.mark.parametrize("listed", [0, 1, 300, 2000])
def test_cascade_is_exact_for_its_universe(spark, listed):
    universe = spark.range(2000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), (F.col("id") < listed).alias("listed"))
    cascade = url_filter.Cascade(universe)
    got = cascade.with_listed(universe.withColumnRenamed("listed", "truth"), F.array("key"))
    assert got.where("truth <> listed").count() == 0


def test_main_path_is_native_and_has_no_join(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = url_filter.judge(pages)._jdf.queryExecution().executedPlan().toString()
    for part in ("Python", "Pandas", "Arrow", "Join"):
        assert part not in plan.split("Subquery")[0]
