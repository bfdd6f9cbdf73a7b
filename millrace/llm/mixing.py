"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Each source has a target, in words. Its rate is target / size: every document is expected that many times. The whole part
is allocated for certain: so many copies of each document. What they leave of the target is the source's room, filled by
one copy more of some documents, with unequal inclusion probabilities: p = least(1, scale * importance), where importance is the bit length
of the document's size unless a caller names another, and the source's scale makes the expected words equal the room.
Where p reaches 1, that copy is certain, too. The others are ranked by random odds divided by inclusion odds,
U / (1 - U) / (p / (1 - p)), and the first ones are taken as long as their words fit into the room. The gap that is left is
closed by the one document among the others that fits it best.

U comes from the document's id and text length only, so reruns agree. Rows that agree in source, id and size are one group
with a count; of the group at the cut as many rows are taken as fit. Ranks are counted in two steps (words per source and
slice of the rank, then the groups of the one slice that holds the cut), so that no task orders a whole source. Importance
is rounded to steps of a twelfth of itself (an eighth of a doubling), at most 1,025 of them, over which scales are found.

Defined results: null and empty texts have size 0 and are taken 0 words. A null source is a source, and null ids are one
id. Of rows that agree in source, id and size, and of which some are taken, it is those read first. An importance that is
null or not above 0 is the least there is. Sources of size 0 have target 0. Without rows there is no result. The weights
need the sources' order: one task sees one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, join_small, settle, word_count

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_COPIES = 2
SLICES = 65_536
SEED = "mix"
NO_ID = -(2**63)  # ranks before all ids
# Importances are powers of 2 ** (1 / STEPS), from 2 ** -MOST_DOUBLINGS to 2 ** MOST_DOUBLINGS.
STEPS, MOST_DOUBLINGS = 8, 64
CERTAIN = -1.0  # ranks before all odds
CHUNK_BITS = 14


def uniform(doc_id: Column, size: Column) -> Column:
    """A number in (0, 1) that depends on the row alone: 52 bits of an MD5."""
    named = F.concat_ws(":", F.lit(SEED), doc_id.cast("string"), size.cast("string"))
    bits = F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with its target.

    Weights go round by the order of the sources, null last. Targets share ``SHARE_PERCENT`` of all words by weight, none
    above ``MOST_COPIES`` times its source; the excess is shared again. So target = least(most, level * weight) for one
    level: with the sources in the order of most / weight, the first ones are full, and the level is what the others share.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1)
    weighed = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(MOST_COPIES))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * (SHARE_PERCENT / 100)
    left = total - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = weighed.withColumn("_level", left / weights)
    # The first source in this order that its share doesn't fill sets the level for itself and all after it.
    open_ = F.when(F.col("_level") * F.col("weight") <= F.col("most"), F.col("_level"))
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    level = F.first(open_, ignorenulls=True).over(running)
    return leveled.withColumn("_l", level).select(
        "source", "source_size", F.coalesce(F.least("most", F.col("_l") * F.col("weight")), F.col("most")).alias("target")
    )


def stepped(importance: Column) -> Column:
    """``importance`` rounded to the steps."""
    steps = F.round(F.log2(importance.cast("double")) * STEPS)
    most = float(MOST_DOUBLINGS * STEPS)
    return F.pow(F.lit(2.0), F.greatest(F.least(F.coalesce(steps, F.lit(-most)), F.lit(most)), F.lit(-most)) / STEPS)


def _rank() -> Column:
    """Random odds over inclusion odds, mapped to (0, 1) in the same order; ``CERTAIN`` where p is 1."""
    p = F.least(F.col("scale") * F.col("importance"), F.lit(1.0))
    odds = F.col("u") / (1 - F.col("u")) / (p / (1 - p))
    return F.when(p >= 1, F.lit(CERTAIN)).otherwise(odds / (1 + odds))


def _scales(classes: DataFrame, aimed: DataFrame) -> DataFrame:
    """Columns sid and scale, for sources with room: with the most important first, those before the first class that
    ``scale * importance`` leaves below 1 are certain, and the others share what these leave of the room."""
    order = Window.partitionBy("sid").orderBy(F.col("importance").desc())
    here = classes.where("words > 0").join(aimed.where("p > 0").select("sid", "room"), "sid")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("words") * F.col("importance")).over(order.rowsBetween(0, Window.unboundedFollowing))
    scaled = here.withColumn("scale", (F.col("room") - before) / rest)
    return scaled.where("scale * importance <= 1").groupBy("sid").agg(F.max_by("scale", "importance").alias("scale"))


_KEY = ("rank", "id", "size")


def plan(sized: DataFrame) -> DataFrame:
    """One row per source: source_size, target, whole (copies of every document), scale, and two groups of equal rows. Of
    the rest, rows before (cut_rank, cut_id, cut_size) are taken once more, of that group itself cut_k rows of cut_n, and
    one of the gap_n rows of (gap_rank, gap_id, gap_size).

    ``sized`` has columns sid, source, id, size, u, importance.
    """
    groups = settle(sized.groupBy("sid", "source", "id", "size", "u", "importance").agg(F.count("*").alias("n")), "groups")
    words = F.sum(F.col("n") * F.col("size"))
    classes = settle(groups.groupBy("sid", "source", "importance").agg(words.alias("words")), "classes")
    aimed = targets(classes.groupBy("sid", "source").agg(F.sum("words").alias("source_size")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # A rate that is whole but for rounding is whole.
    whole = F.least(F.floor(rate + 1e-12), F.lit(MOST_COPIES)).cast("long")
    aimed = aimed.withColumn("whole", whole).withColumn("p", F.greatest(rate - whole, F.lit(0.0)))
    aimed = aimed.withColumn("room", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    aimed = settle(aimed.withColumn("sid", _sid()), "aimed")
    aimed = settle(aimed.join(_scales(classes, aimed), "sid", "left"), "scaled")

    open_ = aimed.where("scale IS NOT NULL").select("sid", "scale", "room")
    ranked = join_small(groups, open_, "sid", "inner").where("size > 0").withColumn("rank", _rank())
    ranked = ranked.select("sid", "id", "size", "n", "rank", "room", F.floor(F.col("rank") * SLICES).cast("int").alias("slice"))

    # Words before each slice, then the slice in which the room ends.
    order = Window.partitionBy("sid").orderBy("slice")
    slices = ranked.groupBy("sid", "slice").agg(words.alias("words"), F.max("room").alias("room"))
    slices = slices.withColumn("before", F.sum("words").over(order) - F.col("words"))
    ends = slices.where("before <= room").groupBy("sid").agg(F.max_by(F.struct("slice", "before"), "slice").alias("end"))
    ends = settle(ends.select("sid", F.col("end.slice").alias("end"), F.col("end.before").alias("before")), "ends")

    near = join_small(ranked, ends, "sid", "inner").where("slice = end")
    inside = Window.partitionBy("sid").orderBy(*_KEY)
    upto = F.col("before") + F.sum(F.col("n") * F.col("size")).over(inside)
    within = near.withColumn("_before", upto - F.col("n") * F.col("size"))
    within = within.withColumn("k", F.least("n", F.expr("(CAST(floor(room) AS BIGINT) - _before) DIV size")))
    taken = within.where("k >= 1").groupBy("sid").agg(F.max_by(F.struct(*_KEY, "n", "k", "_before"), F.struct(*_KEY)).alias("cut"))
    cuts = ends.join(taken, "sid", "left").select(
        "sid",
        F.coalesce(F.col("cut.rank"), F.col("end") / F.lit(float(SLICES))).alias("cut_rank"),
        *[F.col(f"cut.{c}").alias(f"cut_{c}") for c in ("id", "size", "n", "k")],
        F.coalesce(F.col("cut._before") + F.col("cut.k") * F.col("cut.size"), F.col("before")).alias("filled"),
    )
    cuts = settle(cuts, "cuts")
    left = join_small(ranked, cuts, "sid", "inner").where(~_below() & (~_at("cut") | (F.col("cut_k") < F.col("cut_n"))))
    fits = left.withColumn("gap", F.col("room") - F.col("filled")).where("gap > 0 AND abs(gap - size) < gap").groupBy("sid").agg(
        F.min_by(F.struct(*_KEY, "n"), F.struct(F.abs(F.col("gap") - F.col("size")).alias("d"), *_KEY)).alias("gap")
    )
    fits = fits.select("sid", *[F.col(f"gap.{c}").alias(f"gap_{c}") for c in (*_KEY, "n")])
    out = aimed.join(cuts.drop("filled"), "sid", "left").join(fits, "sid", "left")
    return settle(out.drop("room", "source", "p"), "plan")


def _sid() -> Column:
    return F.xxhash64("source", F.col("source").isNull())


def _below() -> Column:
    later = F.struct("id", "size") < F.struct(F.col("cut_id"), F.col("cut_size"))
    tied = (F.col("rank") == F.col("cut_rank")) & F.col("cut_id").isNotNull() & later
    return F.coalesce((F.col("rank") < F.col("cut_rank")) | tied, F.lit(False))


def _at(group: str) -> Column:
    same = [F.col(c) == F.col(f"{group}_{c}") for c in _KEY]
    return F.coalesce(same[0] & same[1] & same[2], F.lit(False))


def _number(rows: DataFrame) -> DataFrame:
    """``rows`` with ``number``, from 1 within rows that agree in sid, id and size. Chunks of rows in the order of reading
    are numbered apart, so that a group of any size is dealt out."""
    pos = settle(rows.withColumn("pos", F.monotonically_increasing_id()), "edge").withColumn("chunk", F.shiftright("pos", CHUNK_BITS))
    key = ["sid", "id", "size"]
    chunks = pos.groupBy(*key, "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("chunk")) - F.col("n")
    chunks = chunks.select(*key, "chunk", before.alias("before"))
    here = pos.withColumn("here", F.row_number().over(Window.partitionBy(*key, "chunk").orderBy("pos")))
    return here.join(chunks, [*key, "chunk"]).withColumn("number", F.col("before") + F.col("here"))


def copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", importance: Column | None = None,
    whole_rows: bool = True,
) -> DataFrame:
    """Columns row (a struct of all columns of ``docs``, or null without ``whole_rows``), id, size, source_size, target and
    copies.

    ``importance`` scales a document's inclusion probability against others of its source; the bit length of its size if
    not given.
    """
    packed = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
        (F.lit(None) if importance is None else importance.cast("double")).alias("importance"),
    )
    if importance is None:
        packed = packed.withColumn("importance", F.length(F.bin("size")))
    packed = packed.withColumn("importance", stepped(F.col("importance")))
    packed = packed.withColumn("u", uniform(F.col("id"), F.col("size"))).withColumn("sid", _sid())
    sized = settle(packed.drop("row"), "sized")
    chosen = plan(sized)
    keyed = packed if whole_rows else sized.withColumn("row", F.lit(None).cast("string"))
    met = join_small(keyed, chosen, "sid", "inner").withColumn("rank", F.when(F.col("size") > 0, _rank()))
    # How many rows of the row's group are taken: null stands for all of them.
    both = F.col("cut_k") + F.when(_at("gap"), 1).otherwise(0)
    part = F.when(_at("cut"), F.when(both < F.col("cut_n"), both)).when(_at("gap"), F.when(F.col("gap_n") > 1, 1))
    again = F.when(F.coalesce(_below() | _at("cut") | _at("gap"), F.lit(False)), 1).otherwise(0)
    out = ["row", "id", "size", "source_size", "target"]
    met = met.select(*out, "sid", "whole", again.alias("again"), part.cast("long").alias("part"))
    done = met.where("part IS NULL").select(*out, (F.col("whole") + F.col("again")).alias("copies"))
    # Only groups of equal rows are ever taken in part; the plan tells whether there are any.
    if chosen.where("cut_n > 1 OR gap_n > 1").take(1):
        some = _number(met.where("part IS NOT NULL"))
        more = F.col("whole") + F.when(F.col("number") <= F.col("part"), 1).otherwise(0)
        done = done.union(some.select(*out, more.alias("copies")))
    return done


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    chosen = copies(docs.select(doc_id, text, source), doc_id, text, source, whole_rows=False)
    return chosen.select(F.nullif("id", F.lit(NO_ID)).alias("id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as it is taken. Documents without words are not taken."""
    chosen = copies(docs, doc_id, text, source).where("copies > 0 AND size > 0")
    return chosen.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


_U = f"(('0x' || substr(md5('{SEED}:' || coalesce(doc_id, {NO_ID}) || ':' || size), 1, 13))::BIGINT + 0.5::DOUBLE) / {2**52}::DOUBLE"
SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
weighty AS (SELECT *, pow(2.0::DOUBLE, round(log2(length(bin(size))) * {STEPS}) / {STEPS}) AS importance FROM sized),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{", ".join(f"{w}.0::DOUBLE" for w in WEIGHTS)}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w
  FROM sized GROUP BY source),
fills(step, level) AS (
  -- Sources above their most are set to it and the rest is shared again, until none is above.
  SELECT 0, (SELECT sum(source_size) * {SHARE_PERCENT / 100} / sum(w) FROM src)::DOUBLE
  UNION ALL
  SELECT step + 1,
         (SELECT (sum(source_size) * {SHARE_PERCENT / 100}
                  - coalesce(sum({MOST_COPIES} * source_size) FILTER (WHERE level * w > {MOST_COPIES} * source_size), 0))
                 / sum(w) FILTER (WHERE level * w <= {MOST_COPIES} * source_size) FROM src)::DOUBLE
  FROM fills WHERE step <= (SELECT count(*) FROM src)),
aimed AS (
  SELECT source, source_size, least(({MOST_COPIES} * source_size)::DOUBLE, max_level * w) AS target
  FROM src, (SELECT max(level) AS max_level FROM fills)),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM aimed),
parts AS (
  SELECT *, least(floor(rate + 1e-12), {MOST_COPIES})::BIGINT AS whole,
         greatest(rate - least(floor(rate + 1e-12), {MOST_COPIES}), 0) AS p FROM rated),
rooms AS (SELECT *, greatest(target - whole * source_size, 0) AS room FROM parts),
classes AS (
  SELECT w.source, w.importance, sum(w.size)::BIGINT AS words, any_value(r.room) AS room
  FROM weighty w JOIN rooms r ON w.source IS NOT DISTINCT FROM r.source
  WHERE r.p > 0 AND w.size > 0 GROUP BY w.source, w.importance),
shared AS (
  SELECT source, importance,
         (room - coalesce(sum(words) OVER (PARTITION BY source ORDER BY importance DESC
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(words * importance) OVER (PARTITION BY source ORDER BY importance DESC
                                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM classes),
scales AS (SELECT source, arg_max(scale, importance) AS scale FROM shared WHERE scale * importance <= 1 GROUP BY source),
ranked AS (
  SELECT s.doc_id, s.size, r.source, r.source_size, r.target, r.whole, r.room, least(k.scale * s.importance, 1) AS p, {_U} AS u,
         row_number() OVER (PARTITION BY s.source, s.doc_id, s.size) AS number
  FROM weighty s JOIN rooms r ON s.source IS NOT DISTINCT FROM r.source LEFT JOIN scales k ON s.source IS NOT DISTINCT FROM k.source),
odds AS (
  SELECT *, CASE WHEN size = 0 OR p IS NULL THEN NULL WHEN p >= 1 THEN {CERTAIN}::DOUBLE ELSE
           (u / (1 - u) / (p / (1 - p))) / (1 + u / (1 - u) / (p / (1 - p))) END AS rank FROM ranked),
summed AS (
  SELECT *, CASE WHEN rank IS NOT NULL THEN
           sum(size) FILTER (WHERE rank IS NOT NULL) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST, size, number
                                                           ROWS UNBOUNDED PRECEDING) END AS upto
  FROM odds),
cut AS (SELECT *, coalesce(upto <= room, FALSE) AS again FROM summed),
gaps AS (SELECT source, any_value(room) - coalesce(sum(size) FILTER (WHERE again), 0) AS gap FROM cut GROUP BY source),
fit AS (
  SELECT c.source, arg_min(struct_pack(r := c.rank, d := c.doc_id, n := c.number),
           struct_pack(d := abs(gap - c.size), r := c.rank, i := coalesce(c.doc_id, {NO_ID}), n := c.number)) AS best
  FROM cut c JOIN gaps g ON c.source IS NOT DISTINCT FROM g.source
  WHERE NOT again AND rank IS NOT NULL AND gap > 0 AND abs(gap - size) < gap GROUP BY c.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN again OR (rank IS NOT NULL AND rank = f.best.r AND doc_id IS NOT DISTINCT FROM f.best.d
                                            AND number = f.best.n)
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM cut c LEFT JOIN fit f ON c.source IS NOT DISTINCT FROM f.source
"""
