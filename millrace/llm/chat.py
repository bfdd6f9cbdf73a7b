"""Chat formatting: roles of a plain transcript's lines by a hidden Markov model, then turns in one form.

A state is a role and whether the line begins a turn or continues it. A line is seen as a symbol: the kind of speaker
marker it begins with, its length, whether it asks. Start, transition and symbol frequencies come from labelled turns; the
most likely states of a transcript's lines are found by Viterbi's algorithm.

A transcript may have any number of lines, so no task holds one whole. Lines are ordered by ranges and cut into blocks of
at most ``BLOCK`` lines. Each block gives a matrix with the best score between any state before it and any state at its
end; matrices of ``FAN`` neighbours are combined, level by level, until every transcript is one. Going back down, each block
learns the states at its two ends on the best path, and finds the states between. The result is that of one pass over the
whole transcript, up to ties between paths of equal probability.

Turns are rendered whole, across blocks: each block tells where its last turn begins and how much of it there is, the
same levels carry that on to later blocks, and so each line knows its turn and how many characters of it come before. A
turn of more than ``PART`` characters comes in numbered parts: a line belongs to the part in which it begins, counted from the
turn's first line, wherever blocks are cut.

Defined results: a null or blank line is a line without marker that continues a turn; null ids are one transcript; lines
that repeat an order key follow each other in the order of their text; roles that the labels don't hold are not found;
without labelled turns every line is a turn of ``user``. A transcript without lines, and a table without rows, gives none.
Extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import settle

ROLES = ("assistant", "system", "user")
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
BLOCK_BITS, FAN_BITS = 8, 6
BLOCK, FAN = 1 << BLOCK_BITS, 1 << FAN_BITS
PART = 1 << 20  # characters

# Names that speakers go by.
SPEAKERS = {
    "user": ("user", "human", "customer", "instruction", "question", "prompt", "q"),
    "assistant": ("assistant", "ai", "bot", "model", "response", "answer", "agent", "a"),
    "system": ("system", "context"),
}
_NAMES = {name: role for role, names in SPEAKERS.items() for name in names}
_MARKER = re.compile(
    rf"\s*(?:#+\s*|\*\*|\[|<\|?)?({'|'.join(sorted(_NAMES, key=len, reverse=True))})(?:\*\*|\]|\|?>)?\s*(?::|$)(?:\*\*)?\s*", re.I
)
_KINDS = ("none", *ROLES)
SYMBOLS = len(_KINDS) * 3 * 2 + 1  # kind, length, question; and the blank line


def marker(line: str | None) -> tuple[str, str]:
    """The role that a line's speaker marker names, or none, and the line without it."""
    found = _MARKER.match(line or "")
    return (_NAMES[found[1].lower()], line[found.end() :]) if found else ("none", line or "")


def symbol(line: str | None) -> int:
    kind, rest = marker(line)
    size = len(rest.split())
    if not size and kind == "none":
        return SYMBOLS - 1
    return (_KINDS.index(kind) * 3 + (size > 3) + (size > 30)) * 2 + rest.rstrip().endswith("?")


class Chain:
    """Logarithms of start, transition and symbol probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, show: np.ndarray) -> None:
        def logs(counts: np.ndarray) -> np.ndarray:
            smooth = counts + 0.01
            return np.log(smooth / smooth.sum(axis=-1, keepdims=True))

        first = start.astype(float)
        first[[not begins for _, begins in STATES]] = -0.01  # a transcript begins with a turn
        with np.errstate(divide="ignore"):
            self.start = np.log((first + 0.01) / (first + 0.01).sum())
        self.move, self.show = logs(move.astype(float)), logs(show.astype(float))
        for i, (role, _) in enumerate(STATES):
            for j, (other, begins) in enumerate(STATES):
                if not begins and role != other:
                    self.move[i, j] = -np.inf  # only the same role goes on

    def matrix(self, symbols: list[int], first: bool) -> np.ndarray:
        """Best scores from the state before to the state at the last line; all rows alike for a transcript's beginning."""
        step = self.start[None, :] if first else self.move
        best = np.repeat(step + self.show[:, symbols[0]], len(STATES) // len(step), axis=0)
        for s in symbols[1:]:
            best = times(best, self.move + self.show[:, s])
        return best

    def path(self, symbols: list[int], first: bool, before: int, last: int) -> list[int]:
        """The best states of a block's lines given the state before it and that of its last line."""
        score = (self.start if first else self.move[before]) + self.show[:, symbols[0]]
        back = []
        for s in symbols[1:]:
            through = score[:, None] + self.move
            back.append(through.argmax(axis=0))
            score = through.max(axis=0) + self.show[:, s]
        states = [last]
        for came in reversed(back):
            states.append(int(came[states[-1]]))
        return states[::-1]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def between(matrices: list[np.ndarray], before: int, last: int) -> list[int]:
    """The best states at the end of each of several blocks, given those before the first and at the end of the last."""
    score, back = matrices[0][before], []
    for m in matrices[1:]:
        through = score[:, None] + m
        back.append(through.argmax(axis=0))
        score = through.max(axis=0)
    states = [last]
    for came in reversed(back):
        states.append(int(came[states[-1]]))
    return states[::-1]


def _symbol_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((len(STATES), SYMBOLS), np.int64)
    for batch in batches:
        for role, lines in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for i, line in enumerate(lines.as_py()):
                counts[STATES.index((role, i == 0)), symbol(line)] += 1
    state, seen = counts.nonzero()
    yield pa.RecordBatch.from_arrays([pa.array(state), pa.array(seen), pa.array(counts[state, seen])], ["state", "symbol", "n"])


def fit(turns: DataFrame) -> Chain:
    """Learn from labelled turns: columns conv, turn (consecutive numbers), role, lines (array). What comes to the driver
    are the counts of states and symbols."""
    turns = turns.where(F.col("role").isin(*ROLES) & (F.size("lines") > 0))
    shown = np.zeros((len(STATES), SYMBOLS))
    counted = turns.select("role", "lines").mapInArrow(_symbol_counts, "state long, symbol long, n long")
    for row in counted.groupBy("state", "symbol").agg(F.sum("n").alias("n")).collect():
        shown[row["state"], row["symbol"]] = row["n"]
    short = turns.select("conv", "turn", "role", F.size("lines").alias("n"))
    then = short.select("conv", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    moves = short.join(then, ["conv", "turn"], "left").groupBy("role", "next", F.least("n", F.lit(2)).alias("kind")).agg(
        F.count("*").alias("turns"), F.sum("n").alias("lines")
    )
    start, move = np.zeros(len(STATES)), np.zeros((len(STATES), len(STATES)))
    for row in moves.collect():
        begin, go = STATES.index((row["role"], True)), STATES.index((row["role"], False))
        if row["kind"] == 2:
            move[begin, go] += row["turns"]
            move[go, go] += row["lines"] - 2 * row["turns"]
        if row["next"] is not None:
            move[go if row["kind"] == 2 else begin, STATES.index((row["next"], True))] += row["turns"]
    for row in short.where("turn = 0").groupBy("role").count().collect():
        start[STATES.index((row["role"], True))] = row["count"]
    if not start.any():
        start[STATES.index(("user", True))] = 1
    return Chain(start, move, shown)


def _blocks(lines: DataFrame) -> DataFrame:
    """Columns conv, block, at (line numbers), lines, first. Within a transcript, block numbers rise with the lines."""
    ordered = lines.repartitionByRange("conv", "order", "line").sortWithinPartitions("conv", "order", "line")
    # Ranges are in order, so these numbers are, too; settled, so that a lost task can't number its lines anew.
    numbered = settle(ordered.withColumn("at", F.monotonically_increasing_id()), "lines")
    grouped = numbered.groupBy("conv", F.shiftright("at", BLOCK_BITS).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", "order", "line"))).alias("lines")
    )
    firsts = numbered.groupBy("conv").agg(F.min(F.shiftright("at", BLOCK_BITS)).alias("head"))
    joined = grouped.join(settle(firsts, "firsts").withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c")))
    return settle(joined.select("conv", "block", "lines", (F.col("block") == F.col("head")).alias("first")), "blocks")


def _over(rows: DataFrame, schema: str, function, *columns: str) -> DataFrame:
    """``function`` of the named columns of each row gives further rows, as tuples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [out for row in batch.to_pylist() for out in function(*(row[c] for c in columns))]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names)

    shape = rows.sparkSession.createDataFrame([], schema).schema
    names = [f.name for f in shape]
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in shape]
    return rows.select(*columns).mapInArrow(run, schema)


def turns(lines: DataFrame, chain: Chain) -> DataFrame:
    """``lines`` has columns conv (long), order (anything that can be compared) and line. One row per recovered turn, or
    part of ``PART`` characters of it: conv, order (of its first line), role, part (from 0), begins, n_lines and rendered.

    Only a turn's first part begins, and has the role's mark; its parts, joined by line breaks, are the turn.
    """
    blocks = _blocks(lines.select("conv", "order", "line"))
    size = len(STATES)

    def first_matrix(conv, block, lines, first):
        found = chain.matrix([symbol(x["line"]) for x in lines], first)
        yield conv, block, found.ravel().tolist()

    def product(conv, block, parts):
        out = None
        for part in parts:
            m = np.array(part["m"]).reshape(size, size)
            out = m if out is None else times(out, m)
        yield conv, block, out.ravel().tolist()

    def ends(conv, block, parts, before, last):
        states = between([np.array(p["m"]).reshape(size, size) for p in parts], before, last)
        for part, i, j in zip(parts, [before, *states], states, strict=False):
            yield conv, part["block"], i, j

    shape = "conv long, block long, m array<double>"
    levels = [settle(_over(blocks, shape, first_matrix, "conv", "block", "lines", "first"), "matrices")]
    groups = []
    while levels[-1].groupBy("conv").count().where("count > 1").take(1):
        grouped = levels[-1].groupBy("conv", F.shiftright("block", FAN_BITS).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("block"), "m"))).alias("parts")
        )
        groups.append(settle(grouped, "groups"))
        levels.append(settle(_over(groups[-1], shape, product, "conv", "block", "parts"), "matrices"))

    def top(conv, block, m):
        yield conv, block, 0, int(np.array(m).reshape(size, size)[0].argmax())

    shape = "conv long, block long, before long, last long"
    known = _over(levels[-1], shape, top, "conv", "block", "m")
    for grouped in reversed(groups):
        met = _with_ends(grouped, known, "before", "last")
        known = settle(_over(met, shape, ends, "conv", "block", "parts", "before", "last"), "ends")

    # Of each block: where its last turn begins, if one does, and the characters from there (or from the block's first line)
    # to the block's end. A later block without a beginning adds to what came before.
    def told(conv, block, lines, first, before, last):
        states = chain.path([symbol(x["line"]) for x in lines], first, before, last)
        begins = [i for i, s in enumerate(states) if STATES[s][1]]
        since = begins[-1] if begins else 0
        yield conv, block, lines[since]["at"] if begins else None, sum(len(x["line"] or "") + 1 for x in lines[since:]), states

    def after(turn, size, part):
        return (turn, size + part["size"]) if part["turn"] is None else (part["turn"], part["size"])

    def total(conv, block, parts):
        turn, size = None, 0
        for part in parts:
            turn, size = after(turn, size, part)
        yield conv, block, turn, size

    def carried(conv, block, parts, turn, size):
        for part in parts:
            yield conv, part["block"], turn, size
            turn, size = after(turn, size, part)

    met = _with_ends(blocks, known, "before", "last")
    shape = "conv long, block long, turn long, size long"
    seen = settle(_over(met, f"{shape}, states array<int>", told, "conv", "block", "lines", "first", "before", "last"), "told")
    level, groups = seen.drop("states"), []
    for _ in levels[1:]:
        grouped = level.groupBy("conv", F.shiftright("block", FAN_BITS).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("block", "turn", "size"))).alias("parts")
        )
        groups.append(settle(grouped, "groups"))
        level = settle(_over(groups[-1], shape, total, "conv", "block", "parts"), "told")
    carry = level.select("conv", "block", F.lit(None).cast("long").alias("turn"), F.lit(0).cast("long").alias("size"))
    for grouped in reversed(groups):
        carry = settle(_over(_with_ends(grouped, carry, "turn", "size"), shape, carried, "conv", "block", "parts", "turn", "size"), "carried")

    def pieces(conv, lines, states, turn, size):
        begin, part = 0, None
        for i, x in enumerate(lines):
            if STATES[states[i]][1]:
                starts, turn, size = True, x["at"], 0
            else:
                starts = False
            if starts or size // PART != part:
                if i > begin:
                    yield piece(conv, lines[begin:i], states[begin], held, part)
                begin, held, part = i, turn, size // PART
            size += len(x["line"] or "") + 1
        yield piece(conv, lines[begin:], states[begin], held, part)

    def piece(conv, lines, state, turn, part):
        role, begins = STATES[state]
        text = [x["line"] or "" for x in lines]
        if begins:
            text[0] = marker(text[0])[1]
            text.insert(0, f"<|{role}|>")
        return conv, turn, part, lines[0]["at"], lines[0]["order"], role, begins, len(lines), "\n".join(text)

    kind = lines.schema["order"].dataType.simpleString()
    out = f"conv long, turn long, part long, at long, order {kind}, role string, begins boolean, n long, text string"
    whole = _with_ends(_with_ends(blocks, seen, "states"), carry, "turn", "size")
    cut = _over(whole, out, pieces, "conv", "lines", "states", "turn", "size")
    parts = cut.groupBy("conv", "turn", "part").agg(
        F.array_sort(F.collect_list(F.struct("at", "order", "role", "begins", "n", "text"))).alias("p")
    )
    return parts.select(
        "conv", F.col("p")[0]["order"].alias("order"), F.col("p")[0]["role"].alias("role"), "part",
        F.col("p")[0]["begins"].alias("begins"),
        F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["n"]).alias("n_lines"),
        F.array_join(F.col("p")["text"], "\n").alias("rendered"),
    )


def _with_ends(blocks: DataFrame, known: DataFrame, *columns: str) -> DataFrame:
    named = known.select(F.col("conv").alias("c"), F.col("block").alias("b"), *columns)
    return blocks.join(named, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")


# The ways in which the query below writes speakers, in the order user, assistant, system.
STYLES = (("User: ", "Assistant: ", "System: "), ("Human: ", "AI: ", "System: "), ("Q: ", "A: ", "Context: "), ("### Question: ", "### Answer: ", "### System: "))
UNMARKED = 7  # one of so many turns has no marker


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """Conversations as plain transcripts: conv, turn, role, lines. The style goes by conversation; some turns have no
    marker. Roles are only for fitting and for measuring."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES))).cast("int")
    places = {"user": 0, "assistant": 1, "system": 2}
    sign = F.lit("")
    for role, i in places.items():
        written = F.element_at(F.array(*[F.lit(s[i]) for s in STYLES]), style + 1)
        sign = F.when(F.col("role") == role, written).otherwise(sign)
    bare = F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(UNMARKED)) == 0
    text = F.concat(F.when(bare, F.lit("")).otherwise(sign), F.coalesce("text", F.lit("")))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", F.split(text, "\n").alias("lines")
    )


def recover(conversations: DataFrame) -> DataFrame:
    """Fit on the conversations outside fold 2 (CRC-32 of the id, modulo 4) and recover the turns of all from their lines."""
    written = transcript_lines(conversations)
    fold = F.crc32(F.coalesce(F.col("conv").cast("string"), F.lit("")).cast("binary")) % 4
    chain = fit(written.where(fold != 2))
    lines = written.select("conv", "turn", F.posexplode("lines").alias("i", "line"))
    order = F.struct(F.col("turn"), F.col("i").cast("long").alias("i"))
    found = turns(lines.select("conv", order.alias("order"), "line"), chain)
    return found.select(
        F.col("conv").alias("conv_id"), F.col("order.turn").alias("turn"), F.col("order.i").alias("line"), "role", "part",
        "begins", "n_lines", "rendered",
    )
