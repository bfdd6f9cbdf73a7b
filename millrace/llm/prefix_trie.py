"""Trie of conversation prefixes: who shares which turns, and what sharing them saves.

1. ``turns`` numbers the turns of each conversation and takes the SHA-256 of each. A prefix's digest is the exclusive or of
   two 64-bit hashes over its numbered turns, so it can be put together from parts of a conversation.
2. ``nodes`` deals the paths' rows into shards of bounded size. In a shard the distinct prefix digests are enumerated and a
   minimal perfect hash gives each a slot; a slot is taken only if it holds the digest asked for. Members are counted into
   flat arrays, one row per slot leaves the shard, and these are added up per digest.
3. What a node adds to its ancestors (itself as a leaf, the characters it saves) is put on the path of its smallest member.
   Each shard then adds up its slots through an array of parent slots, from the deepest turns upward, and the shards'
   sums are added up per digest.

A digest that stood for two different prefixes would show as two different last turns at the smallest depth where it
happens, and the operator fails rather than count them as one.

No conversation, turn or node is held by one task, however large its share. Numbering and digests run over slices of large
conversations (``operators.slices``). A conversation's path is dealt out in segments of ``SEGMENT`` turns; what the lower
segments add is put on the last turn of those above. The ids that end at a node are joined in runs of at most ``RUN``, and
the hash goes over these runs in order.

Defined results: rows without conv_id are left out. Null roles and texts are empty; turns come in the order of ``turn``, null
first, and of the SHA-256 of role and text where they agree, so repeated rows are repeated turns. A conversation that is left
without turns is a member of the root only. A table without rows has no node. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import join_small, settle
from millrace.operators.slices import ROWS_PER_SLICE, Fold, find_cuts, next_row, running_count, scan

SHARE, HEADS = 100, 6
ROWS_PER_SHARD = 250_000
SEGMENT = 16_384
RUN = 4_096

NODE = ["depth", "g1", "g2"]
_LOCAL = "depth long, g1 long, g2 long, p1 long, p2 long, turn binary, n_chars long, n_convs long, conv_id long"
_SUMS = "depth long, g1 long, g2 long, n_leaves long, saved_tokens long"


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SlotTable:
    """Slots 0 .. n - 1 for n distinct pairs of 64-bit numbers.

    Each level is a row of bits; keys that alone hash to a bit own it, the others go to the next level. A key's slot is the
    number of owned bits before its own.
    """

    GAMMA = 2

    def __init__(self, a: np.ndarray, b: np.ndarray) -> None:
        self.levels: list[np.ndarray] = []
        left, given = np.arange(len(a)), 0
        while len(left):
            at = self._at(a[left], b[left], len(self.levels), size := max(self.GAMMA * len(left), 8))
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append(np.where(alone, given + np.cumsum(alone) - 1, -1))
            given += int(alone.sum())
            left = left[~alone[at]]
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        slots = self._slots(a, b)
        self.a[slots], self.b[slots] = a, b

    @staticmethod
    def _at(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
        return (_mix(_mix(a.view(np.uint64) ^ seed) + b.view(np.uint64)) % np.uint64(size)).astype(np.int64)

    def _slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, left = np.full(len(a), -1), np.arange(len(a))
        for level, numbers in enumerate(self.levels):
            found = numbers[self._at(a[left], b[left], level, len(numbers))]
            out[left] = found
            left = left[found < 0]
        return out

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Each pair's slot, -1 for pairs that are not in the table."""
        slots = self._slots(a, b)
        held = (slots >= 0) & (self.a[slots] == a) & (self.b[slots] == b) if len(self.a) else np.zeros(len(a), bool)
        return np.where(held, slots, -1)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    return a[new], b[new]


def _numpy(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(name).to_numpy() for name in names]


def _count_shard(table: pa.Table) -> pa.Table:
    """One row per distinct digest of the shard: its first row's figures, number of members and smallest member."""
    g1, g2, conv = _numpy(table, "g1", "g2", "conv_id")
    slot_of = SlotTable(*_distinct(g1, g2))
    slots = slot_of(g1, g2)
    n = len(slot_of.a)
    n_convs, least, row = np.bincount(slots, minlength=n), np.full(n, np.iinfo(np.int64).max), np.empty(n, np.int64)
    np.minimum.at(least, slots, conv)
    row[slots] = np.arange(len(slots))
    (depth,) = _numpy(table, "depth")
    turn = table.column("turn").combine_chunks()
    if (depth[row[slots]] != depth).any() or not turn.take(pa.array(row[slots])).equals(turn):
        raise ValueError("two prefixes have one digest")
    first = table.select(["depth", "g1", "g2", "p1", "p2", "turn", "n_chars"]).take(pa.array(row))
    return first.append_column("n_convs", pa.array(n_convs, pa.int64())).append_column("conv_id", pa.array(least))


def _add_up_shard(segment: int) -> Callable[[pa.Table], pa.Table]:
    """Sums over the subtrees of a shard's nodes, within segments, of what lies on the shard's paths."""

    def run(table: pa.Table) -> pa.Table:
        depth, g1, g2, p1, p2, leaf, saved = _numpy(table, "depth", "g1", "g2", "p1", "p2", "leaf", "saved")
        slot_of = SlotTable(*_distinct(g1, g2))
        slots = slot_of(g1, g2)
        n = len(slot_of.a)
        depths, parents = np.empty(n, np.int64), np.empty(n, np.int64)
        depths[slots] = depth
        parents[slots] = np.where(depth % segment > 0, slot_of(p1, p2), -1)
        leaves, chars = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(leaves, slots, leaf)
        np.add.at(chars, slots, saved)
        by_depth = np.argsort(-depths, kind="stable")
        for level in np.split(by_depth, np.flatnonzero(np.diff(depths[by_depth])) + 1):
            level = level[parents[level] >= 0]
            np.add.at(leaves, parents[level], leaves[level])
            np.add.at(chars, parents[level], chars[level])
        some = (leaves != 0) | (chars != 0)
        return pa.table(
            {"depth": depths[some], "g1": slot_of.a[some], "g2": slot_of.b[some], "n_leaves": leaves[some], "saved_tokens": chars[some]}
        )

    return run


def turns(conversations: DataFrame, rows_per_slice: int | None = ROWS_PER_SLICE) -> DataFrame:
    """conv_id, n (from 1), turn (SHA-256), n_chars and last (whether no turn follows)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").isNotNull().cast("int").alias("known"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("at"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("turn"),
        F.length(text).cast("long").alias("n_chars"),
    )
    rows = settle(rows, "turns")
    order = ["known", "at", "turn"]
    cuts = find_cuts(rows, ["conv_id"], order, rows_per_slice)
    numbered = scan(rows, ["conv_id"], order, [running_count("n"), next_row("next", "known", order)], cuts)
    return numbered.select("conv_id", "n", "turn", "n_chars", F.col("next").isNull().alias("last"))


def rebuilt(own: DataFrame, share: int = SHARE, heads: int = HEADS) -> DataFrame:
    """Paths (conv_id, depth, turn, n_chars, last) of conversations that begin like the first of their ``share`` ids.

    Conversation c takes the first h turns of c - c % share and goes on with its own after its first h, where h is the CRC-32
    of c in decimal digits, modulo ``heads``. Depth 0 is the row of the root.
    """
    own = settle(own, "own")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    first = own.where((F.col("n") < heads) & (F.col("conv_id") % share == 0))
    first = first.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "turn", "n_chars"))).alias("first"))
    convs = own.where("last").select("conv_id", head.alias("h"), F.col("n").alias("n_own"))
    led = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % share).join(
        first.withColumnRenamed("conv_id", "base"), "base", "left"
    )
    led = led.withColumn("k", F.least("h", F.coalesce(F.size("first"), F.lit(0))).cast("long"))
    led = led.withColumn("length", F.col("k") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    led = settle(led.select("conv_id", "k", "length", "h", F.slice(F.coalesce("first", F.array()), 1, F.col("k").cast("int")).alias("first")), "led")
    root = F.struct(F.lit(0).cast("long").alias("n"), F.lit(b"").alias("turn"), F.lit(0).cast("long").alias("n_chars"))
    lead = led.select("conv_id", "length", F.explode(F.concat(F.array(root), "first")).alias("t"))
    lead = lead.select("conv_id", F.col("t.n").alias("depth"), "t.turn", "t.n_chars", (F.col("t.n") == F.col("length")).alias("last"))
    # Where the first conversation is too short, the own turns move up.
    short = settle(led.where("k < h").select("conv_id", (F.col("h") - F.col("k")).alias("up")), "short")
    rest = join_small(own.where(F.col("n") > head), short, "conv_id")
    rest = rest.select("conv_id", (F.col("n") - F.coalesce("up", F.lit(0))).alias("depth"), "turn", "n_chars", "last")
    return lead.unionByName(rest)


def plain(own: DataFrame) -> DataFrame:
    """Paths of the conversations as they are."""
    root = own.where("n = 1").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("turn"), F.lit(0).cast("long").alias("n_chars"),
        F.lit(False).alias("last"),
    )
    return root.unionByName(own.withColumnRenamed("n", "depth"))


def _xor(name: str, value: Column) -> Fold:
    return Fold(
        name,
        lambda w: F.bit_xor(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        F.bit_xor(value),
        lambda total, w: F.bit_xor(total).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        lambda carried, local: F.coalesce(carried.bitwiseXOR(local), local),
        value,
    )


def _ends(paths: DataFrame) -> DataFrame:
    """Per node at which members end: the SHA-256 of their ids, ascending."""
    run = F.expr(f"conv_id div {RUN}").alias("run")
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    runs = paths.where("last").groupBy(*NODE, run).agg(ids)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for *here, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if here != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = here, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _rows(out)
        if node is not None:
            yield _rows([(*node, state.hexdigest())])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*NODE, "ends_sha256"])

    ordered = runs.repartition(*NODE).sortWithinPartitions(*NODE, "run")
    return ordered.mapInArrow(hashed, "depth long, g1 long, g2 long, ends_sha256 string")


def nodes(
    paths: DataFrame, rows_per_slice: int | None = ROWS_PER_SLICE, rows_per_shard: int = ROWS_PER_SHARD, segment: int = SEGMENT
) -> DataFrame:
    """One row per distinct prefix of the paths: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    items = [F.xxhash64("depth", "turn"), F.xxhash64("turn", "depth", F.lit("second"))]
    rows = settle(paths.withColumns({"i1": items[0], "i2": items[1]}), "items")
    n_rows = rows.count()
    cuts = find_cuts(rows, ["conv_id"], ["depth"], rows_per_slice)
    rows = scan(rows, ["conv_id"], ["depth"], [_xor("g1", F.col("i1")), _xor("g2", F.col("i2"))], cuts)
    shards = max(-(-n_rows // rows_per_shard), 2 * paths.sparkSession.sparkContext.defaultParallelism)
    shard = F.pmod(F.xxhash64("conv_id", F.expr(f"depth div {segment}")), F.lit(shards))
    rows = rows.select(
        "conv_id", "depth", "turn", "n_chars", "last", "g1", "g2",
        F.col("g1").bitwiseXOR(F.col("i1")).alias("p1"), F.col("g2").bitwiseXOR(F.col("i2")).alias("p2"), shard.alias("shard"),
    )
    rows = settle(rows, "paths")

    counted = rows.select("shard", "conv_id", *NODE, "p1", "p2", "turn", "n_chars").groupBy("shard").applyInArrow(_count_shard, _LOCAL)
    same = (F.min("turn") == F.max("turn")) & (F.min("p1") == F.max("p1")) & (F.min("p2") == F.max("p2"))
    made = counted.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.min("n_chars").alias("n_chars"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.assert_true(same, "two prefixes have one digest").alias("one"),
    )
    made = settle(made.where("one IS NULL").drop("one"), "nodes")

    above = (F.col("depth") - 1).alias("depth")
    kids = made.where("depth > 0").groupBy(above, F.col("p1").alias("g1"), F.col("p2").alias("g2")).agg(F.count("*").alias("n_children"))
    made = settle(made.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")

    # What each node adds to its subtree's sums, on its smallest member's path; and what lower segments add to those above.
    own = made.select(
        "conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved")
    )
    part = F.expr(f"depth div {segment}")
    lower = own.where(F.col("depth") >= segment).groupBy("conv_id", part.alias("part")).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    upward = Window.partitionBy("conv_id").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = lower.select("conv_id", "part", *[F.sum(c).over(upward).alias(c) for c in ("leaf", "saved")])
    # The nodes above the first that is the conversation's own are other conversations', and get all of it, too.
    others = lower.groupBy("conv_id").agg(F.min("part").alias("first"), *[F.sum(c).alias(c) for c in ("leaf", "saved")])
    others = others.where("first > 1").select("conv_id", F.explode(F.sequence(F.lit(1), F.col("first") - 1)).alias("part"), "leaf", "saved")
    carried = carried.unionByName(others).select("conv_id", (F.col("part") * segment - 1).alias("depth"), "leaf", "saved")
    given = rows.select("shard", "conv_id", *NODE, "p1", "p2").join(own.unionByName(carried), ["conv_id", "depth"], "left")
    given = given.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("leaf", "saved")}).drop("conv_id")
    sums = given.groupBy("shard").applyInArrow(_add_up_shard(segment), _SUMS)
    sums = sums.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    found = settle(made.join(sums, NODE, "left").join(_ends(rows), NODE, "left"), "sums")
    # Of a node with very many children the rows are split (skew join): both sides are plain tables.
    parents = made.select((F.col("depth") + 1).alias("depth"), F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(parents, ["depth", "p1", "p2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


# The CRC-32 of the digits, bit by bit.
_CRC = """list_reduce(
    flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, s: CASE WHEN s >= 0 THEN xor(a, CAST(s AS BIGINT)) ELSE xor(a >> 1, (a & 1) * 3988292384) END,
    CAST(4294967295 AS BIGINT))"""

SQL = f"""WITH t AS (
  SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS n
  FROM (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
h AS (SELECT c, n_own, xor({_CRC}, CAST(4294967295 AS BIGINT)) % {HEADS} AS h FROM (SELECT c, count(*) AS n_own FROM t GROUP BY c)),
turn AS (
  SELECT h.c, t.n AS d, t.r, t.x FROM h JOIN t ON t.c = h.c - h.c % {SHARE} AND t.n <= h.h
  UNION ALL
  SELECT h.c, least(h.h, coalesce(b.n_own, 0)) + t.n - h.h AS d, t.r, t.x
  FROM h JOIN t ON t.c = h.c AND t.n > h.h LEFT JOIN h b ON b.c = h.c - h.c % {SHARE}),
whole AS (
  SELECT h.c, coalesce(list({{'r': r, 'x': x}} ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS p
  FROM h LEFT JOIN turn ON h.c = turn.c GROUP BY h.c),
pre AS (SELECT c, p, len(p) AS l, unnest(range(0, len(p) + 1)) AS d FROM whole),
member AS (SELECT c, d, l, CASE WHEN d > 0 THEN p[d].x END AS x, min(c) OVER (PARTITION BY d, p[1:d]) AS rep FROM pre),
node AS (
  SELECT rep, d, count(*) AS n_convs, any_value(x) AS x, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE l = d), '') AS ends
  FROM member GROUP BY rep, d),
linked AS (SELECT n.*, m.rep AS parent FROM node n LEFT JOIN member m ON m.c = n.rep AND m.d = n.d - 1),
kids AS (SELECT parent AS rep, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY parent, d),
counted AS (SELECT l.*, coalesce(k.n_children, 0) AS n_children FROM linked l LEFT JOIN kids k ON k.rep = l.rep AND k.d = l.d),
sums AS (
  SELECT m.rep, m.d, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * coalesce(length(n.x), 0)) AS saved
  FROM counted n JOIN member m ON m.c = n.rep AND m.d <= n.d GROUP BY m.rep, m.d)
SELECT n.rep AS conv_id, CAST(n.d AS BIGINT) AS depth, n.parent AS parent_conv_id, n.n_convs, n.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM counted n JOIN sums s ON s.rep = n.rep AND s.d = n.d"""
