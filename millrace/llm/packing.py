"""Best-fit packing of tokenized documents into sequences of a fixed length.

1. A document's ids are those of a tokenizer file, then one end id. Blanks never belong to a token, so a text is tokenized
   run by run between blanks, each distinct run of a batch once, and what a run gave is kept for the words met last.
2. A document longer than a sequence is cut into pieces of a whole sequence each; its last piece may be shorter. No other
   document is cut.
3. Each task packs its pieces online, by bounded-space best fit: a piece goes into the open sequence whose free space is the
   least that suffices. At most ``open_bins`` sequences are open; when another must be opened, the fullest closes first.
   Free spaces are the bits of one integer, so the best fit is the lowest bit set at or above the piece's length, and the
   fullest sequence the lowest bit set at all. Of the ``ROWS`` documents read at a time the longest pieces are placed first.

A task holds a batch of texts, the kept words and ``open_bins`` numbers; pieces leave it as they are placed. There is no
shuffle and no key, so no document or source can be hot. Every task ends with its last sequences unfilled, at most about one
sequence's worth in all, beside thousands in an input split of 128 MB.

Defined results: null and empty texts are the end id alone, one piece of one token. A piece of a full sequence has that
sequence to itself. Rows are independent: repeated rows are packed each, null ids stay null, a table without rows gives none,
and extra columns are not looked at. A lost task packs the same rows the same way again. Strings that look like special
tokens are ordinary text.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SIZE = 2048
END_ID = 0
OPEN_BINS = 1024
# Sequences of different tasks are numbered apart.
TASK_BITS = 33

KEPT = 2**19
LONGEST_KEPT = 64
TOGETHER = 10_000
LAID_WORDS = 2**18
# ASCII marks, but for the apostrophe, which may begin an ending.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
ROWS = 500

PIECE = "piece int, start long, length long, ids binary, sequence_id long, offset long"


class Packer:
    """Places pieces one by one into sequences of ``size`` tokens."""

    def __init__(self, size: int = SIZE, open_bins: int = OPEN_BINS, first: int = 0) -> None:
        self.size, self.open_bins = size, open_bins
        self.next = first
        self.free = 0  # bit f is set where a sequence with f free tokens is open
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]
        self.n_open = 0

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        taken = stack.pop()
        if not stack:
            self.free ^= 1 << free
        self.n_open -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        """The piece's sequence and its offset there."""
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            sequence, free = self.next, self.size
            self.next += 1
            if length < self.size and self.n_open == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
        rest = free - length
        if rest:
            self.bins[rest].append(sequence)
            self.free |= 1 << rest
            self.n_open += 1
        return sequence, self.size - free


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write each byte: printable ones as themselves, the others as U+0100 and on in their order."""
    itself = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in itself]
    return {b: chr(b) for b in itself} | {b: chr(256 + i) for i, b in enumerate(others)}


class Words:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers.

    For byte-level tokenizers that drop blanks, ignore case and part runs of letters from other characters; others are
    refused.
    """

    def __init__(self, tokenizer: str) -> None:
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        probe = "Probing, it's\n\tA  text of 12 words!? (ONE.) abc### Écoutez ÇA, où? de"
        if self.encode([probe]) != [self._ids(probe)]:
            raise ValueError("a tokenizer for which words between blanks are independent is needed")

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: Iterable[bytes]) -> None:
        """Put the words' ids into ``young``. Those that were not met lately are tokenized."""
        young, old = self.young, self.old
        others = []
        for word in words:
            ids = old.get(word)
            if ids is None:
                # Many words differ only in their case or in the marks behind them. Letters below U+0250 are their own
                # normal form; the model takes a run of them as it is.
                letters = word.rstrip(MARKS)
                run = letters.decode().lower()
                if len(word) > LONGEST_KEPT or not (run.isalpha() and max(run) < "\u0250"):
                    others.append(word)
                    continue
                key = run.encode()
                ids = young.get(key) or old.get(key)
                if ids is None:
                    written = run if run.isascii() else key.decode("latin-1").translate(self.letters)
                    ids = young[key] = array("I", [token.id for token in self.model.tokenize(written)]).tobytes()
                marks = word[len(letters) :]
                if marks:
                    if marks not in young:
                        young[marks] = self._ids(marks.decode())
                    ids += young[marks]
            young[word] = ids
        left = iter(others)
        while some := list(islice(left, TOGETHER)):
            texts = [word.decode() for word in some]
            begins = np.cumsum([0, *[len(text) + 1 for text in texts]])
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            starts = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
            ends = (4 * np.searchsorted(starts, begins)).tolist()
            young.update((word, ids[a:b]) for word, a, b in zip(some, ends, ends[1:], strict=False))

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text. Each distinct word is looked up once; numpy lays the ids out in the words' order."""
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        cut = pc.ascii_split_whitespace(pc.fill_null(pa.array(texts, pa.string()), ""))
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        young = self.young
        young[b""] = b""  # blanks at the ends of a text leave empty words
        ids = list(map(young.get, words))
        self._learn([word for word, known in zip(words, ids, strict=True) if known is None])
        ids = [young[word] if known is None else known for word, known in zip(words, ids, strict=True)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begins = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(ids), "<u4")
        order = coded.indices.to_numpy()
        laid = []
        for start in range(0, len(order), LAID_WORDS):
            block = order[start : start + LAID_WORDS]
            n = lengths[block]
            ends = np.cumsum(n)
            laid.append(flat[np.arange(n.sum()) + np.repeat(begins[block] - (ends - n), n)].tobytes())
        out = b"".join(laid)
        bounds = np.concatenate([[0], 4 * np.cumsum(lengths[order])])[cut.offsets.to_numpy()].tolist()
        for word in words:
            if len(word) > LONGEST_KEPT:
                del young[word]
        return [out[i:j] for i, j in zip(bounds, bounds[1:], strict=False)]


_tokenizers: dict[str, Words] = {}


def _words(name: str, tokenizer: str) -> Words:
    """The process's tokenizer of that name: Python workers are used for many tasks."""
    if name not in _tokenizers:
        _tokenizers[name] = Words(tokenizer)
    return _tokenizers[name]


def pack(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset."""
    # A vocabulary of a few MB, whatever the number of documents.
    tokenizer = Tokenizer.from_file(path).to_str()
    name = hashlib.sha256(tokenizer.encode()).hexdigest()
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(name, shipped.value)
        packer = Packer(size, open_bins, TaskContext.get().partitionId() << TASK_BITS)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                pieces = []
                for row, ids in enumerate(words.encode(part.column(1))):
                    ids += end
                    for start in range(0, len(ids) // 4, size):
                        piece = ids[4 * start : 4 * (start + size)]
                        pieces.append((len(piece) // 4, row, start, piece))
                pieces.sort(key=lambda p: p[0], reverse=True)
                rows = pa.array([row for _, row, _, _ in pieces])
                out = [(start // size, start, n, piece, *packer.place(n)) for n, _, start, piece in pieces]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), *columns], ["id", *_NAMES])

    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, {PIECE}")


_NAMES = [field.split()[0] for field in PIECE.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length, and ids and document ids of the pieces in their order.

    A sequence has at most its size in pieces, all made by one task.
    """
    pieces = F.sort_array(F.collect_list(F.struct("offset", "id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), pieces.alias("p")).select(
        "sequence_id",
        "length",
        F.aggregate(F.col("p.ids"), F.lit(b""), lambda done, ids: F.concat(done, ids)).alias("ids"),
        F.col("p.id").alias("doc_ids"),
        F.col("p.offset").alias("offsets"),
    )


def digests(packed: DataFrame) -> DataFrame:
    """Packed pieces with the checksum of their ids in place of the ids."""
    return packed.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
