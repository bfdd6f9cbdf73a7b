"""Near-duplicate documents by HyperMinHash.

1. A document's shingles are hashed and thrown into ``BUCKETS`` buckets, again and again while one is empty; of each bucket's
   least hash in the first throw that hits it a 16-bit register holds the number of leading zeros and the ten bits behind
   the leading one. Two registers are equal with the Jaccard similarity as probability, whatever the sizes (plus rare
   collisions of compressed values). The first ``BUCKETS`` registers are kept whole, of all others the last bit.
2. Documents with the same words are one class, found by shuffling digests. One row per class goes on.
3. Bands of ``ROWS`` registers: classes that share a band may be linked. A pair at 0.8 shares none of 64 bands with a
   probability of 4e-9.
4. Of a band's classes not all pairs are formed. Its hub is the class that shares bands most often (``stars``). Each class is
   first paired with the hub it shares most bands with, then with its other hubs outside its component. Pairs whose
   estimate, corrected for chance collisions of registers, is too low go; the rest are confirmed on the whole texts.
   Hubs around which all classes lie in one component are done. The classes around the others are paired by the rarest shingles
   in which they differ from the hub (``prefix_tokens``), missing ones as well as added ones. Two linked classes without such a
   shingle in common are both linked with the hub: it lies between them (with D for the number of differences and q for
   (1 - s)/(1 + s), D(x) + D(y) <= q(|x| + |y|) and |y| <= |hub| + D(y) give D(x) <= q(|x| + |hub|)). So no link is
   left out, and classes that share only what the hub has, too, are never paired.
5. Components of all confirmed links; the smallest doc_id names each.

Defined results: a document without words (null, empty or blank text) has an empty set and is linked with nothing. Rows
that share a doc_id are one document: they stay or go together. Rows without doc_id are not linked: component_id is null
and they are kept. A table without rows gives none. Extra columns pass through ``drop_near_copies`` untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import few_broadcasts, join_small, settle
from millrace.llm.components import components

ROWS, BANDS = 6, 64
BUCKETS = ROWS * BANDS
MANTISSA = 10
THROWS = 63
PERCENT = 80  # links have at least this similarity
# Six standard deviations of the estimate of a pair at the threshold.
LEAST_ESTIMATE = PERCENT / 100 - 6 * (PERCENT / 100 * (1 - PERCENT / 100) / BUCKETS) ** 0.5
# Counters of the frequencies that order shingles, a byte each (four steps an octave): those of rare shingles may be shared.
COUNTERS = 2**20
STEPS = 4

NONE = np.uint64(2**64 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, BUCKETS + 1, dtype=np.uint64))
_THROW_SEEDS = _mix(np.arange(10_001, 10_001 + THROWS, dtype=np.uint64))


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z lower-cased; ``bytes.split`` splits at exactly the six blank characters."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles, or of the whole sequence if it is shorter."""
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)] if words else [], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = _mix(out + each[j : j + n])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The ``BUCKETS`` compressed registers of a set of hashes that isn't empty.

    A bucket takes its value from the first throw that hits it: the throw's number stands above the hash, so that the
    least number is the least hash of that throw. Once all buckets are hit, further throws change nothing.
    """
    least = np.full(BUCKETS, NONE)
    step = max(1, 8192 // len(hashes))
    for begin in range(0, THROWS, step):
        throws = np.arange(begin, min(begin + step, THROWS), dtype=np.uint64)
        thrown = _mix(hashes[None, :] ^ _THROW_SEEDS[throws.astype(np.int64)][:, None])
        at = ((thrown >> np.uint64(32)) * np.uint64(BUCKETS)) >> np.uint64(32)
        values = (_mix(thrown) >> np.uint64(6)) | (throws << np.uint64(58))[:, None]
        np.minimum.at(least, at.astype(np.int64).ravel(), values.ravel())
        empty = np.flatnonzero(least == NONE)
        if not len(empty):
            break
    for some in np.array_split(empty, 1 + len(empty) * len(hashes) // 1_000_000) if len(empty) else ():
        least[some] = _mix(hashes[None, :] ^ _SEEDS[some][:, None]).min(axis=1) >> np.uint64(6)
    top = (least & np.uint64(2**58 - 1)) >> np.uint64(5)  # 53 bits, exact as doubles
    zeros = (53 - np.frexp(top.astype(np.float64))[1]).astype(np.uint64)
    mantissa = ((top << zeros) >> np.uint64(52 - MANTISSA)) & np.uint64(2**MANTISSA - 1)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype("<u2")


def _collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of two disjoint sets of n and m shingles agree."""
    zeros = np.arange(54)[:, None]

    def in_band(size: np.ndarray) -> np.ndarray:
        load = np.maximum(size / BUCKETS, 1)
        return (1 - 2.0 ** -(zeros + 1)) ** load - (1 - 2.0**-zeros) ** load

    return (in_band(n) * in_band(m)).sum(axis=0) / 2**MANTISSA


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, corrected for chance collisions."""
    chance = _collisions(n, m)
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def _sign(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                digests, sizes, signs = [], [], []
                for text in part.column(1).to_pylist():
                    words = words_of(text)
                    hashes = shingle_hashes(words, k)
                    digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    sizes.append(len(hashes))
                    signs.append(registers(hashes).tobytes() if words else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(signs, pa.binary()),
                    ],
                    ["id", "digest", "n", "signature"],
                )

    return run


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, BUCKETS) for c in ("sa", "sb")
            )
            n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
            keep = pa.array(estimate(a, b, n, m) >= LEAST_ESTIMATE)
            yield batch.select(["a", "b"]).filter(keep)


def shingle_set(text: str | None, k: int) -> set:
    words = words_of(text)
    return set(zip(*(words[j:] for j in range(k)), strict=False)) if len(words) >= k else {tuple(words)} if words else set()


def linked(one: set, other: set) -> bool:
    shared = len(one & other)
    return shared > 0 and 100 * shared >= PERCENT * (len(one) + len(other) - shared)


def _confirm(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("ta"), batch.column("tb"), strict=True):
                one = one.as_py()
                if one != last:  # rows come in the order of a
                    last, held = one, shingle_set(one, k)
                keep.append(linked(held, shingle_set(other.as_py(), k)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose registers make a link possible."""
    signed = classes.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    with_b = pairs.join(signed, "b").join(
        signed.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("sb").alias("sa")), "a"
    )
    sized = with_b.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT)
    return settle(sized.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_close, "a long, b long"), "close")


def confirm(close: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Those of the pairs (a, b) that are links: their whole texts meet."""
    ids = settle(close.select(F.col("a").alias("id")).union(close.select("b")).distinct(), "ids")
    texts = settle(join_small(docs, ids, "id", "left_semi").select("id", "text"), "texts")
    met = close.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a"
    )
    return settle(met.select("a", "b", "ta", "tb").mapInArrow(_confirm(k), "a long, b long").distinct(), "links")


def _hashed(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(words_of(text), k).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("v"), pa.array(sets, pa.binary())], ["v", "hashes"])

    return run


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each item: size, whether it can be linked with its center, and the shingles that only one of the two has, mixed with
    the center's number."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            marks = _mix(part.column("center").to_numpy().view(np.uint64))
            sizes, near, out = [], [], []
            for mark, one, other in zip(marks, part.column("hashes").to_pylist(), part.column("middle").to_pylist(), strict=True):
                one, other = np.frombuffer(one, "<u8"), np.frombuffer(other, "<u8")
                differ = np.setxor1d(one, other, assume_unique=True)
                sizes.append(len(one))
                near.append((100 + PERCENT) * len(differ) <= (100 - PERCENT) * (len(one) + len(other)))
                out.append(_mix(differ + mark).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("center", "v", "label")),
                    pa.array(sizes, pa.int64()),
                    pa.array(near, pa.bool_()),
                    pa.array(out, pa.binary()),
                ],
                ["center", "v", "label", "n", "near", "hashes"],
            )


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        hashes = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), "<u8")
        counts += np.bincount((hashes % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["counter", "n"])


def prefix_lengths(n: np.ndarray, differ: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many of the rarest of n shingles must be looked at as the smaller, and as the larger set of a pair.

    With similarity s at least p/100 and |x| <= |y|, x and y have at least 2s/(1 + s) |x| shingles in common, and at least
    s |y|. In any one order of all shingles the first of these is among so many first ones of each.

    With ``differ`` the same for the differences of x and y from a common center. Linked sets differ in at most
    (1 - s)/(1 + s) (|x| + |y|) shingles, and |y| is at most |x|/s. What x has before the first that both hold is part of
    that, and no more than half of it in the smaller of the two lists.
    """
    if differ is not None:
        apart = (100 - PERCENT) * n // PERCENT  # (1 - s)/(1 + s) (n + n/s)
        return np.minimum(differ, apart // 2 + 1), np.minimum(differ, apart + 1)
    most = -(-2 * PERCENT * n // (100 + PERCENT))
    return n - most + 1, n - -(-PERCENT * n // 100) + 1


def _prefixes(counts) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                tokens, sizes = [], []
                for hashes, n in zip(part.column("hashes").to_pylist(), part.column("n").to_pylist(), strict=True):
                    hashes = np.frombuffer(hashes, "<u8")
                    frequency = counts.value[(hashes % np.uint64(COUNTERS)).astype(np.int64)]
                    tokens.append(hashes[np.lexsort((hashes, frequency))[: prefix_lengths(n, len(hashes))[1]]].view(np.int64))
                    sizes.append(len(hashes))
                lengths = [len(t) for t in tokens]
                row = pa.array(np.repeat(np.arange(part.num_rows), lengths))
                at = np.concatenate([np.arange(n) for n in lengths]) if lengths else np.empty(0, np.int64)
                differ = np.repeat(np.array(sizes, np.int64), lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(row) for c in ("v", "label", "n", "near")),
                        pa.array(differ),
                        pa.array(np.concatenate(tokens)) if tokens else pa.array([], pa.int64()),
                        pa.array(at),
                    ],
                    ["v", "label", "n", "near", "differ", "token", "at"],
                )

    return run


def differences(edges: DataFrame, texts: Callable[[DataFrame], DataFrame], k: int) -> DataFrame:
    """Items against their centers (``edges``: center, v, label): center, v, label, n (size), near, hashes (of what differs)."""
    needed = settle(edges.select("v").union(edges.select("center")).distinct(), "needed")
    hashed = settle(texts(needed).select("v", "text").mapInArrow(_hashed(k), "v long, hashes binary"), "hashed")
    # Rows may share an id: a center is one of its texts, the same for all.
    centers = hashed.join(settle(edges.select(F.col("center").alias("v")).distinct(), "centers"), "v")
    middles = settle(centers.groupBy(F.col("v").alias("center")).agg(F.min("hashes").alias("middle")), "middles")
    met = edges.join(hashed, "v").join(middles, "center").select("center", "v", "label", "hashes", "middle")
    return settle(met.mapInArrow(_differences, "center long, v long, label long, n long, near boolean, hashes binary"), "differences")


def levels(differ: DataFrame) -> np.ndarray:
    """Of each counter the logarithm of its frequency, in whole steps: a byte of each is enough for an order."""
    counted = differ.select("hashes").mapInArrow(_frequencies, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n") * STEPS)
    packed = counted.select((F.col("counter") * 256 + level).cast("int").alias("packed"))
    packed = packed.toArrow().column("packed").to_numpy()  # at most COUNTERS numbers, 4 MB
    out = np.zeros(COUNTERS, np.uint8)
    out[packed >> 8] = packed & 255
    return out


def prefix_tokens(differ: DataFrame) -> DataFrame:
    """Of each item's differences from a center the rarest ones, as many as a pair may need: v, label, n (size), near, differ
    (their number), token, at (place in the order).

    The order is that of a fixed number of counters and then of the hashes. Counters may be shared by several shingles: that
    costs pairs to look at, never a link.
    """
    shipped = differ.sparkSession.sparkContext.broadcast(levels(differ))
    rows = differ.select("v", "label", "n", "near", "hashes")
    return settle(rows.mapInArrow(_prefixes(shipped), "v long, label long, n long, near boolean, differ long, token long, at long"), "prefixes")


def prefix_pairs(tokens: DataFrame) -> DataFrame:
    """Pairs (x, lx, v, label) of different labels that can be links: one of their rarest differences from a center is common
    to both, and not both can be linked with the center itself."""
    smaller = tokens.where(F.col("at") <= F.floor(F.floor(F.lit(100 - PERCENT) * F.col("n") / PERCENT) / 2))
    smaller = smaller.select(
        "token", *(F.col(c).alias(name) for c, name in (("v", "x"), ("label", "lx"), ("n", "nx"), ("differ", "dx"), ("at", "ax"), ("near", "_near")))
    )
    ordered = (F.col("dx") < F.col("differ")) | ((F.col("dx") == F.col("differ")) & (F.col("x") < F.col("v")))
    sized = F.least("nx", "n") * 100 >= F.greatest("nx", "n") * PERCENT
    # Were this their first common difference, so many could be common in all.
    left = F.least(F.col("dx") - F.col("ax"), F.col("differ") - F.col("at"))
    apart = F.col("dx") + F.col("differ") - 2 * left
    enough = apart * (100 + PERCENT) <= (F.col("nx") + F.col("n")) * (100 - PERCENT)
    far = ~(F.col("_near") & F.col("near"))
    met = smaller.join(tokens, "token").where(ordered & sized & (F.col("lx") != F.col("label")) & enough & far)
    return settle(met.select("x", "lx", "v", "label").distinct(), "pairs")


def stars(members: DataFrame) -> DataFrame:
    """Each item with the hubs of its keys (hub, v, count: keys in common). A key's hub is the one of its items that shares
    its keys most often: of alike items the one in their middle, and the same one in most of their keys."""
    sizes = settle(members.groupBy("key").count(), "sizes")
    scores = settle(members.join(sizes, "key").groupBy("v").agg(F.sum("count").alias("score")), "scores")
    hubs = members.join(scores, "v").groupBy("key").agg(F.max_by(F.col("v"), F.struct("score", -F.col("v"))).alias("hub"))
    met = members.join(settle(hubs, "hubs"), "key").where("v <> hub")
    return settle(met.groupBy("hub", "v").count(), "stars")


def cluster(members: DataFrame, confirm: Callable[[DataFrame], DataFrame], texts: Callable[[DataFrame], DataFrame], k: int) -> DataFrame:
    """Components of the links between items that share a key: columns v and label (see ``components``).

    ``members`` has columns key and v; ``confirm`` gives those of the pairs (a, b) that are links,
    and ``texts`` adds the column text to a table with a column v. Every link between two items of a key is found or lies
    within a component.
    """
    met = stars(members)
    best = met.groupBy("v").agg(F.max_by(F.struct("hub"), F.struct("count", -F.col("hub"))).alias("best"))
    tried = settle(best.select(F.col("best.hub").alias("a"), F.col("v").alias("b")), "tried")

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        return components(labels.select(F.col("label").alias("a"), F.col("v").alias("b")).union(links))

    def named(labels: DataFrame) -> DataFrame:
        of_hubs = labels.select(F.col("v").alias("hub"), F.col("label").alias("of_hub"))
        both = met.join(labels, "v", "left").join(of_hubs, "hub", "left")
        return both.select(F.col("hub").alias("center"), "v", F.coalesce("label", "v").alias("label"), F.coalesce("of_hub", "hub").alias("of_hub"))

    labels = components(confirm(tried))
    more = named(labels).where("label <> of_hub").select(F.col("center").alias("a"), F.col("v").alias("b"))
    more = settle(more.join(tried, ["a", "b"], "left_anti"), "tried")
    labels = joined(labels, confirm(more))

    # Hubs whose other items are of several components: those of one have nothing left to be paired.
    now = settle(named(labels), "named")
    mixed = now.groupBy("center").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
    mixed = settle(mixed.select("center"), "mixed")
    edges = settle(now.join(mixed, "center").select("center", "v", "label", "of_hub"), "open")
    if edges.isEmpty():
        return labels
    differ = differences(edges, texts, k)
    pairs = prefix_pairs(prefix_tokens(differ))

    # Of each item and other component one pair first; most need no other.
    first = pairs.groupBy("x", "label").agg(F.min("v").alias("b")).select(F.col("x").alias("a"), "b")
    labels = joined(labels, confirm(settle(first, "first")))
    now = labels.withColumnRenamed("label", "now")
    rest = pairs.withColumn("first", F.min("v").over(Window.partitionBy("x", "label"))).where("v <> first").select("x", "v")
    rest = rest.join(now.select(F.col("v").alias("x"), F.col("now").alias("nx")), "x", "left").join(now, "v", "left")
    rest = rest.where(F.coalesce("nx", "x") != F.coalesce("now", "v")).select(F.col("x").alias("a"), F.col("v").alias("b"))
    return joined(labels, confirm(settle(rest, "rest")))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    with few_broadcasts(docs.sparkSession):
        signed, groups = _grouped(docs, doc_id, text, k)
    # Not broadcast where the caller runs it, either.
    rows = signed.join(groups.hint("merge"), "digest", "left").select("id", F.col("n").alias("n_shingles"), "component_id")
    named_id = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id"))
    return rows.select(
        "id", "n_shingles", named_id.alias("component_id"), F.coalesce(F.col("id") == named_id, F.lit(True)).alias("kept")
    )


def _grouped(docs: DataFrame, doc_id: str, text: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The signed documents, and of each class of equal texts (digest) its component_id."""
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = settle(docs.mapInArrow(_sign(k), "id long, digest binary, n long, signature binary"), "signed")

    first = Window.partitionBy("digest").orderBy("id")
    present = signed.where("id IS NOT NULL AND n > 0")
    classes = present.withColumn("_r", F.row_number().over(first)).where("_r = 1")
    classes = settle(classes.select(F.col("id").alias("v"), "n", "signature"), "classes")

    width = 2 * ROWS
    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.xxhash64(F.substring("signature", j * width + 1, F.lit(width)), j)
    )
    bands = classes.select("v", F.explode(band).alias("key"))

    # Bands that two classes or more share.
    shared = bands.groupBy("key").agg(F.min("v").alias("least"), F.max("v").alias("last")).where("least < last")
    members = settle(bands.join(settle(shared.select("key"), "shared"), "key"), "members")

    def texts(some: DataFrame) -> DataFrame:
        return join_small(docs, some.withColumnRenamed("v", "id"), "id", "inner").withColumnRenamed("id", "v")

    labels = cluster(members, lambda pairs: confirm(estimated(pairs, classes), docs, k), texts, k)

    # Of each class, then of each row. Copies of one text may be very many: the small tables are settled first, so that
    # the joins can be split.
    groups = present.groupBy("digest").agg(F.min("id").alias("v"))
    groups = groups.join(labels, "v", "left").select("digest", F.coalesce("label", "v").alias("component_id"))
    return signed, settle(groups, "groups")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """The rows that are kept, whole: of each component the document with the smallest id."""
    gone = near_groups(docs, doc_id, text, k).where("NOT kept").select(F.col("id").alias("_gone")).distinct()
    gone = settle(gone, "gone")
    packed = docs.select(F.struct("*").alias("_row"), F.col(doc_id).cast("long").alias("_gone"))
    return join_small(packed, gone, "_gone", "left_anti").select("_row.*")
