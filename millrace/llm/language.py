"""Language ID by prediction by partial matching.

For each language a context tree of the last ``ORDER`` bytes counts what follows. The code length of a byte is that of
method C with exclusion: in the longest known context of d different followers and n in all, a follower seen k times has
probability k / (n + d), and an escape, d / (n + d), leads to the next shorter context, in which followers already
ruled out don't count; below the empty context, all bytes left are equally likely. After fitting, the counts don't
change, so the length of a byte after a context is a number in a table, and a text's is a sum over its bytes. The language
with the shortest code is the prediction; the score is its share of 2 ** -length over all languages.

Fitting takes a bounded sample: of each language the ``SAMPLE_DOCS`` documents that come first by a hash of doc_id, whole.
Contexts are kept while the table stays within ``TABLE_BYTES``, the most frequent first.

Defined results: null text, text without a letter, and any text if nothing could be learned, give ``und`` and score 0.
A null doc_id counts as an empty one for the fold. Between equal code lengths the first language by name wins. Rows are
judged one by one; repeated rows give equal results; extra columns are not looked at; without rows there is no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import join_small, settle

ORDER = 4
SAMPLE_DOCS = 300
TABLE_BYTES = 48_000_000
UNKNOWN = "und"


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def _bytes(text: str) -> np.ndarray:
    """The lower-cased text in UTF-8, after ORDER zero bytes that stand for its beginning."""
    return np.frombuffer(bytes(ORDER) + text.lower().encode(), np.uint8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the (ORDER + 1)-byte strings of each language."""
    for batch in batches:
        for lang, some in batch.to_pandas().groupby("lang"):
            grams = []
            for text in some["text"]:
                x = _bytes(text).astype(np.int64)
                n = len(x) - ORDER
                grams.append(sum(x[j : j + n] << (8 * (ORDER - j)) for j in range(ORDER + 1)))
            gram, n = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(gram), "gram": gram, "n": n.astype(np.int64)})


class Model:
    """Code lengths in bits of each byte after each context, for all languages at once.

    A context is a path in one tree over all languages, from the last byte back; ``child[node, symbol]`` is the next node
    or 0. Symbol 0 is any byte that the sample doesn't hold, so it has no children but a cost.
    """

    def __init__(self, grams: pd.DataFrame) -> None:
        """``grams`` has columns lang, gram, n."""
        self.langs = sorted(grams["lang"].unique())
        parts = [(grams["gram"].to_numpy(np.int64) >> (8 * j)) & 255 for j in range(ORDER + 1)]  # parts[0] follows the context
        lang = np.searchsorted(self.langs, grams["lang"]) if len(grams) else np.zeros(0, np.int64)
        n = grams["n"].to_numpy(np.float64)
        present = np.unique(np.concatenate(parts)) if len(n) else np.zeros(0, np.int64)
        self.symbol = np.zeros(256, np.int32)
        self.symbol[present] = np.arange(1, len(present) + 1)
        size, languages = len(present) + 1, max(len(self.langs), 1)
        symbols = [self.symbol[p].astype(np.int64) for p in parts]
        room = max(TABLE_BYTES // (4 * size * (languages + 1)), 1)

        # Contexts by frequency; those of a higher order are never more frequent than the ones they prolong.
        codes, code = [], np.zeros(len(n), np.int64)
        for d in range(1, ORDER + 1):
            code = code * size + symbols[d]
            codes.append(code)
        totals = [np.unique(c, return_inverse=True) for c in codes]
        weights = [np.bincount(inverse, n, len(u)) for u, inverse in totals]
        every = np.sort(np.concatenate([*weights, np.zeros(0)]))[::-1]
        least = every[room - 1] if len(every) >= room else 0.0

        self.child = np.zeros((1, size), np.int32)
        node = np.zeros(len(n), np.int64)  # of each gram, the node of its context at the order reached; -1: not kept
        levels = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]  # per order its nodes and their parents
        at = [node.copy()]
        for d, ((_, inverse), weight) in enumerate(zip(totals, weights, strict=True), 1):
            kept = np.flatnonzero(weight > least)
            new = np.full(len(weight), -1)
            new[kept] = len(self.child) + np.arange(len(kept))
            chosen = new[inverse]
            first = pd.DataFrame({"new": chosen, "parent": node, "symbol": symbols[d]}).query("new >= 0").drop_duplicates("new")
            first = first.sort_values("new")
            self.child = np.vstack([self.child, np.zeros((len(kept), size), np.int32)])
            self.child[first["parent"], first["symbol"]] = first["new"]
            levels.append((first["new"].to_numpy(), first["parent"].to_numpy()))
            node = chosen
            at.append(node.copy())
        self.cost = np.zeros((len(self.child), size, languages), np.float32)
        for k in range(len(self.langs)):
            mine = lang == k
            counts = np.zeros((len(self.child), size))
            for nodes in at:
                some = mine & (nodes >= 0)
                np.add.at(counts, (nodes[some], symbols[0][some]), n[some])
            self._fill(counts, levels, k)

    def _fill(self, counts: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], k: int) -> None:
        parent = np.zeros(len(counts), np.int64)
        for nodes, parents in levels:
            parent[nodes] = parents
        for d, (nodes, _) in enumerate(levels):
            if not len(nodes):
                continue
            cost = np.zeros((len(nodes), counts.shape[1]))
            open_ = np.ones(cost.shape, bool)  # not met in a longer context
            now = nodes
            for _ in range(d + 1):
                here = counts[now] * open_
                seen = here > 0
                total, kinds = here.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
                known = total > 0
                with np.errstate(divide="ignore", invalid="ignore"):
                    cost = np.where(seen, cost - np.log2(here / (total + kinds)), cost)
                    escape = np.where(known, -np.log2(kinds / (total + kinds)), 0.0)
                cost = np.where(open_ & ~seen, cost + escape, cost)
                open_ &= ~seen
                now = parent[now]
            left = 256 - (~open_).sum(axis=1, keepdims=True)
            self.cost[nodes, :, k] = np.where(open_, cost + np.log2(np.maximum(left, 1)), cost)

    def lengths(self, text: str) -> np.ndarray:
        """Code length of the text in each language."""
        x = self.symbol[_bytes(text)]
        total = np.zeros(self.cost.shape[2])
        for start in range(ORDER, len(x), 1 << 18):
            stop = min(start + (1 << 18), len(x))
            node = np.zeros(stop - start, np.int32)
            alive = np.ones(stop - start, bool)
            for d in range(1, ORDER + 1):
                longer = self.child[node, x[start - d : stop - d]]
                alive &= longer > 0
                node = np.where(alive, longer, node)
            total += self.cost[node, x[start:stop]].sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        bits = self.lengths(text)
        best = int(bits.argmin())
        return self.langs[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from the rows with a text and a language."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.xxhash64(F.col(doc_id).cast("string")).alias("h"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    # Hashes are even, so the least ones of a language lie below a share of the range that its count gives; four times the
    # sample pass on average, and only those are ranked.
    narrow = rows.select("lang", "h")
    counts = settle(narrow.groupBy("lang").agg(F.count("*").alias("rows")), "counts")
    near = join_small(narrow, counts, "lang", "inner").where(
        F.col("h").cast("double") + 2.0**63 <= 2.0**64 * 4 * SAMPLE_DOCS / F.col("rows")
    )
    first = Window.partitionBy("lang").orderBy("h")
    chosen = near.select("lang", "h").withColumn("r", F.row_number().over(first)).where(F.col("r") <= SAMPLE_DOCS)
    chosen = settle(chosen.select("h").distinct(), "sample")
    sample = join_small(rows, chosen, "h", "left_semi").select("lang", "text")
    grams = sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return Model(grams.toPandas())


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns id, lang_pred, score. The model, at most ``TABLE_BYTES``, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, rows.select("id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema)


def predict_folds(docs: DataFrame) -> DataFrame:
    """Learn from the documents outside fold 2 and judge all: doc_id, held_out, lang_pred, score."""
    model = fit(docs.where(fold(F.col("doc_id")) != 2))
    judged = identify(docs, model)
    return judged.select(F.col("id").alias("doc_id"), (fold(F.col("id")) == 2).alias("held_out"), "lang_pred", "score")
