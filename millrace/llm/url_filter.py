"""URL filters: allow and block rules, then exact membership in a block list by a cascade of Bloom filters.

A key is a host or one of its parent domains. The universe is every key of every URL in the corpus; some of its keys are
listed. The first filter encodes the listed keys, the second those other keys that pass the first by chance, the third
the listed keys that pass the second, and so on until nothing passes by chance. For keys of the universe the first filter
that a key fails tells whether it is listed, without error and without a join: the filters are constants of the plan.

Their size grows with the list, so it is checked: beyond ``MAX_FILTER_BITS`` the listed hosts are joined instead.
DataFrame functions only.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed. Repeated
rows are judged alike; extra columns are not looked at; an empty list blocks nothing; a table without rows gives none.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import join_small, settle

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values: (verdict, rule); a rule is a host and the beginning of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# The keys that begin with one of these labels are listed.
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")

FIRST_ERROR = 0.01  # chance of the first filter; deeper ones have one half
MAX_FILTER_BITS = 2**26  # of all filters together: 8 MB


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for _, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, text).otherwise(found)
    return found


def keys(host: Column) -> Column:
    """A host and its parent domains."""
    labels = F.split(host, r"\.")
    return F.when(
        host != "",
        F.transform(
            F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
        ),
    ).otherwise(F.array().cast("array<string>"))


def _size(members: int, others: int, first: bool) -> tuple[int, int]:
    """Words of 64 bits and hash functions of a filter."""
    error = min(0.5, FIRST_ERROR * members / others) if first and others else 0.5
    hashes = max(1, round(-math.log2(error)))
    return max(1, math.ceil(members * hashes / math.log(2) / 64)), hashes


def _bit(key: Column, level: int, j: int, words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(words * 64))


def _passes(key: Column, bits: Column, level: int, words: int, hashes: int) -> Column:
    out = F.lit(True)
    for j in range(hashes):
        at = _bit(key, level, j, words)
        out = out & (F.getbit(F.get(bits, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1)
    return out


def _filter(members: DataFrame, level: int, words: int, hashes: int) -> DataFrame:
    """One row with the filter's words; at most ``MAX_FILTER_BITS`` by the check before."""
    at = members.select(F.explode(F.array(*[_bit(F.col("key"), level, j, words) for j in range(hashes)])).alias("at"))
    set_ = at.groupBy(F.floor(F.col("at") / 64).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 AS INT))")).alias("bits")
    )
    every = members.sparkSession.range(words).withColumnRenamed("id", "w").join(set_, "w", "left")
    listed = F.array_sort(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return settle(every.agg(F.transform(listed, lambda x: x["bits"]).alias("bits")), "filter")


class Cascade:
    """Exact membership for the keys of ``universe``: columns key (distinct) and listed."""

    def __init__(self, universe: DataFrame, max_bits: int = MAX_FILTER_BITS) -> None:
        self.levels: list[tuple[DataFrame, int, int]] = []
        self.fits = True
        counts = {r["listed"]: r["count"] for r in universe.groupBy("listed").count().collect()}
        inside, outside, total = counts.get(True, 0), counts.get(False, 0), 0
        left = universe.select("key", F.col("listed").alias("in"))
        while inside:
            words, hashes = _size(inside, outside, not self.levels)
            total += words * 64
            if total > max_bits:
                self.fits = False
                return
            level = len(self.levels)
            made = _filter(left.where("in"), level, words, hashes)
            self.levels.append((made, words, hashes))
            passed = _passes(F.col("key"), made.scalar(), level, words, hashes)
            wrong = settle(left.where(~F.col("in")).where(passed).select("key"), "wrong")
            # The next filter encodes what passed by chance, against what this one encodes.
            left = wrong.select("key", F.lit(True).alias("in")).unionByName(
                left.where("in").select("key", F.lit(False).alias("in"))
            )
            inside, outside = wrong.count(), inside

    def with_listed(self, rows: DataFrame, many: Column) -> DataFrame:
        """``rows`` with the column listed: whether one of the keys in ``many``, all of the universe, is listed."""
        if not self.levels:
            return rows.withColumn("listed", F.lit(False))

        def walk(key: Column, level: int) -> Column:
            if level == len(self.levels):
                return F.lit(level % 2 == 1)
            _, words, hashes = self.levels[level]
            passed = _passes(key, F.col("_filters")[level], level, words, hashes)
            return F.when(passed, walk(key, level + 1)).otherwise(F.lit(level % 2 == 1))

        # The filters are scalar subqueries: each runs once, and its one value is a constant of the tasks.
        filters = F.array(*[made.scalar() for made, _, _ in self.levels])
        met = rows.withColumn("_filters", filters)
        return met.withColumn("listed", F.exists(many, lambda key: walk(key, 0))).drop("_filters")


def judge(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES,
    labels: Sequence[str] = LISTED_LABELS, max_bits: int = MAX_FILTER_BITS,
) -> DataFrame:
    """One row per page: id, host, path, rule (or null), listed (by the block list) and verdict."""
    parsed = pages.select(F.col(page_id).alias("id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    hosts = settle(parsed.select("host").distinct(), "hosts")
    universe = hosts.select(F.explode(keys(F.col("host"))).alias("key")).distinct()
    universe = settle(universe.withColumn("listed", F.substring_index("key", ".", 1).isin(*labels)), "universe")
    cascade = Cascade(universe, max_bits)
    if cascade.fits:
        judged = cascade.with_listed(parsed, keys(F.col("host")))
    else:
        each = hosts.select("host", F.explode(keys(F.col("host"))).alias("key"))
        blocked = each.join(universe.where("listed"), "key", "left_semi").select("host").distinct()
        blocked = settle(blocked.withColumn("listed", F.lit(True)), "blocked")
        judged = join_small(parsed, blocked, "host").withColumn("listed", F.coalesce("listed", F.lit(False)))
    found = judged.withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    says = F.when(F.col("listed"), "block").otherwise("allow")
    for verdict, text in rules:
        says = F.when(F.col("rule") == text, verdict).otherwise(says)
    return found.select("id", "host", "path", "rule", "listed", says.alias("verdict"))


_RULE = "CASE " + " ".join(
    f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}') THEN '{h}/{p}'"
    for h, p in (t.split("/", 1) for t in sorted((t for _, t in RULES), key=len, reverse=True))
) + " END"
_LISTED = ", ".join(f"'{x}'" for x in LISTED_LABELS)
SQL = f"""
WITH parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path FROM pages),
ruled AS (SELECT *, {_RULE} AS rule, len(list_intersect(string_split(host, '.'), [{_LISTED}])) > 0 AS listed FROM parsed)
SELECT page_id, host, path, rule, listed,
       CASE {" ".join(f"WHEN rule = '{t}' THEN '{v}'" for v, t in RULES)}
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
