"""Hard negatives: of each anchor and each of its best rows of its own label, the best rows of other labels a step below.

1. ``encode`` turns each vector by fixed random signs and Walsh-Hadamard transforms and stores ``LEVELS`` one-bit codes: the
   signs of the turned vector, then those of what the code leaves over, and so on. With each code its alignment is kept
   (the inner product of code and vector), and at the end the length of what is left over.
2. An anchor is turned the same way. Its inner product with a coded vector is the sum of those with the signs of each code
   times their alignment: one matrix product for a block of anchors and the decoded codes of a block of rows.
3. By Cauchy-Schwarz the true product differs from that estimate by at most (length left over) x (anchor's length). No
   probability is involved: a pair is dropped only where its interval shows that it can't be among the first. The matrix product
   is in single precision, for which the intervals have room, and holds their upper ends at once (``Queries.reach``).
4. Pairs whose interval reaches the current threshold are scored with the integer vectors. The first of each group stand in a
   table; what is new is ordered with those of its own groups only (``Best``).

Anchors are dealt into blocks of about ``ANCHORS`` and rows into blocks; every block of anchors meets every block of rows
once, in a task that holds one block of anchors and a batch of rows. A task passes on only the first few of each
anchor. Two such passes: positives, then negatives within the bands that the positives give. Work grows with anchors times
rows, as searching all rows for a stated share of them does; nothing is left out by it, so recall is 1.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. Shorter vectors
count as zero in the components that they lack; an empty vector scores 0. Of rows that share an id the one with the
smallest label, then the smallest vector, stands for all. Equal scores are ordered by id. An anchor alone with its label has
no positives and gives no row; a positive of negative score has no negatives, since its band is empty. A table without rows
gives none. Extra columns are not looked at. Scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import settle

POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
SCALE = 256
LEVELS = 4
ANCHORS = 16_384
ROWS = 100_000
# Rows and anchors that meet in one step.
ROW_STEP, ANCHOR_STEP = 1024, 256

_ENCODED = "vec_id long, label long, anchor boolean, x binary, codes binary, align binary"


def turned(x: np.ndarray) -> np.ndarray:
    """Rows turned by a fixed rotation; their number of components is a power of two."""
    n = x.shape[1]
    signs = np.random.default_rng(20_240_229).choice([-1.0, 1.0], (2, n))
    for sign in signs:
        x = x * sign
        step = 1
        while step < n:
            pairs = x.reshape(len(x), n // (2 * step), 2, step)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
            step *= 2
        x = x / np.sqrt(n)
    return x


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-bit codes (rows, levels, words), and per row the alignments, the coded vector's length and the length left over."""
    left = turned(x)
    n = x.shape[1]
    codes, align, made = [], [], np.zeros_like(left)
    for _ in range(LEVELS):
        bits = left >= 0
        a = np.abs(left).sum(axis=1) / np.sqrt(n)
        step = np.where(bits, 1.0, -1.0) * (a / np.sqrt(n))[:, None]
        made, left = made + step, left - step
        codes.append(_words(bits))
        align.append(a)
    lengths = [np.linalg.norm(made, axis=1), np.linalg.norm(left, axis=1)]
    return np.stack(codes, axis=1), np.stack([*align, *lengths], axis=1)


def decoded(codes: np.ndarray, align: np.ndarray) -> np.ndarray:
    """The turned vectors that codes and alignments stand for."""
    n = 64 * codes.shape[2]
    made = np.zeros((len(codes), n))
    for level in range(LEVELS):
        bits = np.unpackbits(np.ascontiguousarray(codes[:, level]).view(np.uint8), axis=1, bitorder="little")
        made += (2.0 * bits - 1) * (align[:, level] / np.sqrt(n))[:, None]
    return made


class Queries:
    """A block of anchors: integer vectors, and turned ones with their length behind them."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.n = x.shape[1]
        q = turned(x)
        self.length = np.linalg.norm(q, axis=1)
        self.q = np.column_stack([q, self.length])
        # Products of longer vectors could be too large for single precision.
        self.short = self.q.astype(np.float32) if self.length.max(initial=0) < 1e15 else None

    def open(self, codes: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decoded rows with half the width of their intervals, as a multiple of the anchor's length, behind them; the halves."""
        length, left = align[:, -2], align[:, -1]
        # Far more than single precision can be off in a sum of so many products.
        half = left + (self.n + 16) * 2.0**-22 * (left + length)
        return np.column_stack([decoded(codes, align), half]), half

    def reach(self, at: slice | np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Upper ends of the intervals of the anchors ``at`` and opened rows, but for ``FREE``."""
        if self.short is None or np.abs(rows).max(initial=0) >= 1e15:
            return self.q[at] @ rows.T
        return self.short[at] @ rows.astype(np.float32).T

    def interval(self, at: np.ndarray, codes: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products of the anchors ``at`` with coded rows."""
        rows, half = self.open(codes, align)
        high = self.reach(at, rows).astype(np.float64) + FREE
        return high - 2 * (self.length[at][:, None] * half + FREE), high

    def scores(self, at: np.ndarray, rows: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in ``at`` and ``rows`` where ``mask`` holds, and the exact inner products there."""
        i, j = _places(mask)
        return i, j, self.products(at, rows, i, j)

    def products(self, at: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The exact inner products of the anchors ``at[i]`` and ``rows[j]``."""
        a, b = self.x[at], rows
        if len(a) and len(b) and np.abs(a).max() * np.abs(b).max() * self.n >= 2**53:
            return np.array([sum(int(u) * int(v) for u, v in zip(a[p], b[q], strict=True)) for p, q in zip(i, j, strict=True)], np.int64)
        if 20 * len(i) > len(a) * len(b):
            return (a @ b.T).ravel()[i * len(b) + j].astype(np.int64)
        return np.einsum("ij,ij->i", a[i], b[j]).astype(np.int64)


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.nonzero`` of a table."""
    return np.divmod(np.flatnonzero(mask), max(mask.shape[1], 1))


class Best:
    """The first ``k`` of each group by score, then by id."""

    def __init__(self, groups: int, k: int, floor: np.ndarray) -> None:
        self.k = k
        self.least = floor  # per group: no lower score can come in any more
        self.count = np.zeros(groups, np.int64)
        self.scores, self.ids = np.zeros((groups, k), np.int64), np.zeros((groups, k), np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        met = score >= self.least[group]
        if not met.any():
            return
        some = np.unique(group[met])
        held = self._held(some)
        group = np.r_[np.repeat(some, self.count[some]), group[met]]
        score = np.r_[self.scores[some][held], score[met]]
        ids = np.r_[self.ids[some][held], ids[met]]
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[first, len(group)])
        rank = np.arange(len(group)) - np.repeat(first, sizes)
        kept = rank < self.k
        self.scores[group[kept], rank[kept]], self.ids[group[kept], rank[kept]] = score[kept], ids[kept]
        self.count[some] = np.minimum(sizes, self.k)
        full = rank == self.k - 1
        self.least[group[full]] = np.maximum(self.least[group[full]], score[full])

    def _held(self, groups: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.arange(self.k) < self.count[groups][:, None]

    @property
    def group(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    @property
    def score(self) -> np.ndarray:
        return self.scores[self._held()]

    @property
    def id(self) -> np.ndarray:
        return self.ids[self._held()]


LOWEST = np.iinfo(np.int64).min
FREE = 1e-3  # added to all intervals


def _below(threshold: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Thresholds as a column of floating point numbers that aren't larger, less ``FREE``."""
    return np.nextafter((threshold.astype(np.float64) - FREE).astype(kind), kind.type(-np.inf))[:, None]


class Positives:
    """Of each anchor the first rows of its label."""

    fields = "anchor_id long, vec_id long, score long"

    def __init__(self, anchors: list[pa.RecordBatch], width: int) -> None:
        self.ids, self.labels = _column(anchors, "vec_id"), _column(anchors, "label")
        self.queries = Queries(_matrix(anchors, "x", "<f8", width))
        self.best = Best(len(self.ids), POSITIVES, np.full(len(self.ids), LOWEST))

    def meet(self, rows: Block) -> None:
        opened, half = self.queries.open(rows.codes, rows.align)
        for label in np.intersect1d(rows.label, self.labels):
            some, at_label = np.flatnonzero(rows.label == label), np.flatnonzero(self.labels == label)
            for begin in range(0, len(at_label), ANCHOR_STEP):
                at = at_label[begin : begin + ANCHOR_STEP]
                high = self.queries.reach(at, opened[some])
                itself = self.ids[at][:, None] == rows.id[some]
                least = self.best.least[at]
                if len(some) > POSITIVES and (self.best.count[at] < POSITIVES).any():
                    # So many lie above the k-th lower bound.
                    low = high.astype(np.float64) - 2 * self.queries.length[at][:, None] * half[some]
                    low[itself] = -np.inf
                    least = np.maximum(least, -np.partition(-low, POSITIVES - 1, axis=1)[:, POSITIVES - 1] - 2 * FREE)
                i, j, score = self.queries.scores(at, rows.x[some], (high >= _below(least, high.dtype)) & ~itself)
                self.best.add(at[i], score, rows.id[some][j])

    def result(self) -> pa.RecordBatch:
        best = self.best
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[best.group]), pa.array(best.id), pa.array(best.score)], ["anchor_id", "vec_id", "score"]
        )


class Negatives:
    """Of each anchor and positive the first rows of other labels within the positive's band."""

    fields = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"

    def __init__(self, anchors: list[pa.RecordBatch], width: int) -> None:
        self.ids, self.labels = _column(anchors, "vec_id"), _column(anchors, "label")
        self.queries = Queries(_matrix(anchors, "x", "<f8", width))
        positives = [p for batch in anchors for p in batch.column("positives").to_pylist()]
        self.positive = np.array([[p["vec_id"] for p in ps] + [0] * (POSITIVES - len(ps)) for ps in positives], np.int64)
        scores = np.array([[p["score"] for p in ps] + [-1] * (POSITIVES - len(ps)) for ps in positives], np.int64)
        self.positive_score = scores.ravel()
        self.low = -(-LOW_PERCENT * scores // 100)
        self.high = HIGH_PERCENT * scores // 100
        self.best = Best(scores.size, NEGATIVES, self.low.ravel().copy())

    def meet(self, rows: Block) -> None:
        opened, half = self.queries.open(rows.codes, rows.align)
        is_open = self.low <= self.high
        roof = np.where(is_open, self.high, LOWEST).max(axis=1).astype(np.float64)
        for begin in range(0, len(self.ids), ANCHOR_STEP):
            at = np.arange(begin, min(begin + ANCHOR_STEP, len(self.ids)))
            high = self.queries.reach(at, opened)
            # Of the positives the one with the lowest threshold; which bands hold a pair its score tells.
            least = np.where(is_open[at], self.best.least.reshape(-1, POSITIVES)[at], np.inf).min(axis=1)
            i, j = _places(high >= _below(least, high.dtype))
            length, width = self.queries.length[at], 2 * (half + FREE)
            low = high.ravel()[i * len(half) + j] - (length + 1)[i] * width[j]
            may = (low <= roof[at][i]) & (self.labels[at][i] != rows.label[j])
            i, j = i[may], j[may]
            score = self.queries.products(at, rows.x, i, j)
            pair, p = np.nonzero((score[:, None] >= self.low[at[i]]) & (score[:, None] <= self.high[at[i]]))
            self.best.add(at[i[pair]] * POSITIVES + p, score[pair], rows.id[j[pair]])

    def result(self) -> pa.RecordBatch:
        best = self.best
        columns = [self.ids[best.group // POSITIVES], self.positive.ravel()[best.group], self.positive_score[best.group], best.id, best.score]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in self.fields.split(", ")])


def _column(batches: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([b.column(name).to_numpy() for b in batches])


def _matrix(batches: list[pa.RecordBatch], name: str, dtype: str, width: int) -> np.ndarray:
    whole = b"".join(value for b in batches for value in b.column(name).to_pylist())
    return np.frombuffer(whole, dtype).reshape(-1, width)


class Block:
    """Some rows with their codes."""

    def __init__(self, batch: pa.RecordBatch, width: int) -> None:
        self.id, self.label = _column([batch], "vec_id"), _column([batch], "label")
        self.x = _matrix([batch], "x", "<f8", width)
        self.codes = _matrix([batch], "codes", "<u8", LEVELS * width // 64).reshape(-1, LEVELS, width // 64)
        self.align = _matrix([batch], "align", "<f8", LEVELS + 2)


def _meet(kind: type, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches come cell by cell, and in a cell the anchors before the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors, search = None, [], None
        for batch in batches:
            cells, sides = batch.column("cell").to_numpy(), batch.column("side").to_numpy()
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(sides) != 0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if cells[begin] != cell:
                    if search is not None:
                        yield search.result()
                    cell, anchors, search = cells[begin], [], None
                if sides[begin] == 0:
                    anchors.append(part)
                elif anchors or search is not None:
                    if search is None:
                        search, anchors = kind(anchors, width), []
                    for at in range(0, part.num_rows, ROW_STEP):
                        search.meet(Block(part.slice(at, ROW_STEP), width))
        if search is not None:
            yield search.result()

    return run


def _encode(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROW_STEP):
                part = batch.slice(begin, ROW_STEP)
                vectors = part.column("x")
                lengths = vectors.value_lengths().to_numpy()
                x = np.zeros((part.num_rows, width))
                x[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy()
                codes, align = coded(x)
                packed = [pa.array([row.tobytes() for row in m], pa.binary()) for m in (x, codes, align)]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("vec_id", "label", "anchor")] + packed, names)

    names = [field.split()[0] for field in _ENCODED.split(", ")]
    return run


def integers(embeddings: DataFrame, label: Column, vector: str = "embedding") -> DataFrame:
    """vec_id, label and x, the vector's components times ``SCALE`` rounded down, of the rows that take part."""
    x = F.col(vector)
    whole = F.transform(x, lambda v: _floor(F.lit(float(SCALE)) * v.cast("double")))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) != F.lit(float("inf"))))
    rows = embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull() & x.isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("x"))


def _floor(value: Column) -> Column:
    """The floor as a double; beyond 2^53 every double is whole."""
    return F.when(F.abs(value) < 2.0**53, F.floor(value).cast("double")).otherwise(value)


def encode(rows: DataFrame, anchor: Column) -> tuple[DataFrame, int]:
    """The stored table of codes, one row per id, and the width of its vectors."""
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row")).select("vec_id", "row.label", "row.x")
    one = settle(one.withColumn("anchor", anchor), "vectors")
    longest = one.agg(F.max(F.size("x"))).first()[0] or 0
    width = max(64, 1 << max(longest - 1, 0).bit_length())
    return settle(one.select("vec_id", "label", "anchor", "x").mapInArrow(_encode(width), _ENCODED), "codes"), width


def _search(rows: DataFrame, anchors: DataFrame, kind: type, width: int, per_row_block: int, per_anchor_block: int) -> DataFrame:
    """Each block of anchors meets each block of rows."""
    spread = 2 * rows.sparkSession.sparkContext.defaultParallelism
    n_rows, n_anchors = rows.count(), anchors.count()
    # At most so many rows a block, and enough blocks for all cores.
    row_blocks = max(-(-n_rows // per_row_block), min(spread, -(-n_rows // ROW_STEP)), 1)
    anchor_blocks = max(-(-n_anchors // per_anchor_block), 1)
    row_block = F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks))
    anchor_block = F.pmod(F.xxhash64("vec_id", F.lit("anchor")), F.lit(anchor_blocks))

    def cells(df: DataFrame, side: int, own: Column, others: Column, number: Callable[[Column, Column], Column]) -> DataFrame:
        dealt = df.withColumn("_other", F.explode(F.sequence(F.lit(0), others - 1)))
        return dealt.select(number(own, F.col("_other")).cast("long").alias("cell"), F.lit(side).alias("side"), *columns)

    columns = ["vec_id", "label", "x", "codes", "align", "positives"]
    left = cells(anchors, 0, anchor_block, F.lit(row_blocks), lambda a, r: r * anchor_blocks + a)
    right = rows.withColumn("positives", F.lit(None).cast(anchors.schema["positives"].dataType))
    right = cells(right, 1, row_block, F.lit(anchor_blocks), lambda r, a: r * anchor_blocks + a)
    dealt = left.unionByName(right).repartitionById(row_blocks * anchor_blocks, F.col("cell").cast("int"))
    dealt = dealt.sortWithinPartitions("cell", "side")
    return dealt.mapInArrow(_meet(kind, width), kind.fields)


def mine(rows: DataFrame, anchor: Column, rows_a_block: int = ROWS, anchors_a_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and x (whole numbers as doubles); ``anchor`` tells from these which rows are anchors.
    """
    table, width = encode(rows, anchor)
    none = F.lit(None).cast("array<struct<vec_id:long,score:long>>")
    anchors = table.where("anchor").withColumn("positives", none)
    found = _search(table, anchors, Positives, width, rows_a_block, anchors_a_block)
    first = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= POSITIVES)
    positives = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    anchors = settle(anchors.drop("positives").join(settle(positives, "positives"), "vec_id"), "anchors")

    found = _search(table, anchors, Negatives, width, rows_a_block, anchors_a_block)
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    return ranked.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


SQL = f"""WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda v: floor({SCALE} * CAST(v AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT a, b, score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES})
SELECT p.a AS anchor_id, p.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS INTEGER) AS rank,
       n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN pairs n ON n.a = p.a AND NOT n.same
  AND {LOW_PERCENT} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH_PERCENT} * p.score
QUALIFY rank <= {NEGATIVES}"""
