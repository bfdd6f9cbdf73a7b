"""Byte-level BPE encoding and decoding with a given vocabulary.

A text is cut into pre-tokens by a pattern; each is encoded by itself, in two tiers:

1. A minimal perfect hash over the vocabulary gives the one slot at which a pre-token could be a whole token; if the bytes
   at that slot are its bytes, the slot's rank is the answer.
2. Otherwise its bytes form a linked list, and a heap of mergeable neighbours, ordered by rank and then position, merges
   the best pair until none is left.

Both tiers work on memory of constant size. What they found is kept for the words met last, so that frequent words are
looked up once per task; a generation of ``KEPT`` words replaces the one before the last.

Defined results: null counts as empty, an empty text has no tokens and decodes to nothing. Every text can be encoded,
because every byte is a token, and decodes to its own bytes. Rows are independent: repeated rows give equal results, no
shuffle takes place, and a table without rows gives none. Extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT = 2**18
LONGEST_KEPT = 64
# A blank between blanks, or at the end after one: only there does cutting a text before its blanks change pre-tokens.
BLANK_RUN = re.compile(r"\s (?:\s|\Z)| \Z")


class MinimalPerfectHash:
    """Maps n byte strings to 0 .. n - 1, one to one.

    Each level is a bit array in which the keys that hash to a bit of their own are set; the others go to the next level.
    A key's number is the number of bits set before its own, over all levels.
    """

    GAMMA = 2.0

    def __init__(self, keys: list[bytes]) -> None:
        sizes: list[int] = []
        bits, left = [], keys
        while left:
            size = max(int(len(left) * self.GAMMA), 8)
            at = np.array([xxhash.xxh3_64_intdigest(k, len(sizes)) % size for k in left])
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            sizes.append(size)
            left = [k for k, own in zip(left, alone[at].tolist(), strict=True) if not own]
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        # Per bit the number of its key, or -1.
        numbers = np.where(flat, np.cumsum(flat) - 1, -1).tolist()
        starts = np.cumsum([0, *sizes]).tolist()
        self.levels = [numbers[a:b] for a, b in zip(starts, starts[1:], strict=False)]

    def __call__(self, key: bytes) -> int:
        """The key's number; for a string that is not a key, any number or -1."""
        seed = 0
        for numbers in self.levels:
            number = numbers[xxhash.xxh3_64_intdigest(key, seed) % len(numbers)]
            if number >= 0:
                return number
            seed += 1
        return -1


class Codec:
    """Encoder and decoder for one vocabulary (bytes to rank) and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.whole = MinimalPerfectHash(list(ranks))
        self.slots: list[tuple[bytes, int]] = [(b"", -1)] * len(ranks)
        for token, rank in ranks.items():
            self.slots[self.whole(token)] = (token, rank)
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        every = range(256)
        self.byte_pairs = {(a, b): ranks.get(bytes((a, b))) for a in every for b in every}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def pre_token(self, text: str) -> bytes:
        """Ids of a pre-token, as little-endian unsigned 32-bit integers."""
        piece = text.encode()
        token, rank = self.slots[self.whole(piece)]
        ids = [rank] if token == piece else self.merge(piece)
        return struct.pack(f"<{len(ids)}I", *ids)

    def merge(self, piece: bytes) -> list[int]:
        """Ranks of a pre-token that is no token: always the pair of least rank, the leftmost first, is merged.

        A heap entry is one number: rank, begin and end of a pair, in this order of digits.
        """
        n, ranks = len(piece), self.ranks
        width = n.bit_length()
        low = (1 << width) - 1
        end = list(range(1, n + 1))  # of the part that begins here; 0: merged into an earlier one
        before = list(range(-1, n))
        heap = [
            (r << width | i) << width | i + 2
            for i, r in enumerate(map(self.byte_pairs.__getitem__, zip(piece, piece[1:], strict=False)))
            if r is not None
        ]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            stop, i = entry & low, entry >> width & low
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two has changed meanwhile
            end[i], end[middle] = stop, 0
            before[stop] = i
            if stop < n and (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r << width | i) << width | end[stop])
            if (left := before[i]) >= 0 and (r := ranks.get(piece[left:stop])) is not None:
                heapq.heappush(heap, (r << width | left) << width | stop)
        return [ranks[piece[i : end[i]]] for i in range(n) if end[i]]

    def chunk(self, text: str) -> bytes:
        """Ids of a piece of text."""
        pieces, out = self.pieces, []
        for piece in self.find(text):
            ids = pieces.get(piece)
            if ids is None:
                ids = self.pre_token(piece)
                if len(pieces) >= KEPT:
                    pieces.clear()
                if len(piece) <= LONGEST_KEPT:
                    pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def remembered(self, word: str) -> bytes:
        """Ids of a blank and the word after it."""
        found = self.old.get(word)
        if found is None:
            found = self.chunk(" " + word)
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        if len(word) <= LONGEST_KEPT:
            self.young[word] = found
        return found

    def encode(self, text: str) -> bytes:
        # A pre-token never goes on over a blank between other characters, so the text may be cut before each.
        if BLANK_RUN.search(text):
            return self.chunk(text)
        first, *rest = text.split(" ")
        get, slow = self.young.get, self.remembered
        out = [self.chunk(first)]
        for word in rest:
            ids = get(word)
            if ids is None:
                ids = slow(word)
                get = self.young.get
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token in base64 and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


_codecs: dict[tuple[str, str], Codec] = {}


def codec(name: str, ranks: dict[bytes, int], pattern: str) -> Codec:
    """The process's codec for a vocabulary: Python workers are used for many tasks."""
    if (name, pattern) not in _codecs:
        _codecs[name, pattern] = Codec(ranks, pattern)
    return _codecs[name, pattern]


def _shipped(docs: DataFrame, path: str) -> tuple[str, object]:
    """A vocabulary's name and its ranks, broadcast: a file of some hundred kB, whatever the number of documents."""
    ranks = load_ranks(path)
    name = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    return name, docs.sparkSession.sparkContext.broadcast(ranks)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns id and ids, the token ids as little-endian unsigned 32-bit integers in one binary."""
    name, ranks = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(name, ranks.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids = [one.encode(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, chosen.select("id", F.lit(b"").alias("ids")).schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Of columns id and ids: id, ids and decoded, the bytes of the tokens one after the other."""
    name, ranks = _shipped(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(name, ranks.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [one.decode(ids.as_py()) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary())], ["id", "ids", "decoded"])

    encoded = encoded.select("id", "ids")
    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit(b"")).schema)


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, then decode what was encoded, in one pass: id, n_tokens, ids_sha256, decoded_sha256."""
    name, ranks = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(name, ranks.value, pattern)
        for batch in batches:
            counts, hashes, decoded = [], [], []
            for text in batch.column(1):
                ids = one.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                hashes.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(one.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    empty = rows.select("id", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256"))
    return rows.mapInArrow(run, empty.schema)
