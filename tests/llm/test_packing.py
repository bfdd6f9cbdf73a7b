from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from millrace.llm import packing, queries
from tests.llm.conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, plain, size=packing.SIZE):
    """Every token of every document is in one piece, and the pieces of a sequence lie side by side within its size."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        ids = np.array(plain(texts[doc]), "<u4").tobytes()
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [size * i for i in range(len(pieces))]
        assert b"".join(bytes(r.ids) for r in pieces) == ids
        assert all(r.length == len(r.ids) // 4 for r in pieces) and len(pieces) == -(-len(ids) // 4 // size)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return by_sequence


def test_whole_table(spark, documents, plain):
    rows = packing.pack(documents, PATH).collect()
    used = check(rows, {r.doc_id: r.text for r in documents.collect()}, plain)
    least = -(-sum(r.length for r in rows) // packing.SIZE)
    assert len(used) <= least + 1 + least // 100


def test_query_is_the_digest_of_the_pieces(spark, documents, plain):
    got = {(r.doc_id, r.piece): r for r in queries.op11_packing(spark, SF).collect()}
    for doc in documents.collect():
        ids = plain(doc.text)
        for piece, start in enumerate(range(0, len(ids), packing.SIZE)):
            part = np.array(ids[start : start + packing.SIZE], "<u4").tobytes()
            row = got.pop((doc.doc_id, piece))
            assert (row.start, row.length, row.ids_crc32) == (start, len(part) // 4, zlib.crc32(part))
    assert not got


def test_words_equal_the_library(plain):
    rng = random.Random(3)
    some = "aAzÉé ß'sS漢1２.<|>\t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　̸́ΣςσİıﬁÅÅé🙂‍\U0001d400"
    texts = ["".join(rng.choices(some, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["<|endoftext|>", "it's I'LL don't <|startoftext|> x", "x" * 5000, " " * 3000, "ΣΑΣ ΣΑΣ. ΟΔΟΣ"]
    words = packing.Words(Tokenizer.from_file(PATH).to_str())
    for text, ids in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text)[:-1], repr(text)
    assert max(map(len, words.young)) <= packing.LONGEST_KEPT


def test_words_are_forgotten_and_met_again(plain, monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 3)
    words = packing.Words(Tokenizer.from_file(PATH).to_str())
    for text in ["a b c d", "a e", "e f b", "g", "a b g", "", "a h i j k", "c a"]:
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == plain(text)[:-1]


def test_packer_is_bounded_best_fit():
    """Against a plain search over all open bins."""
    rng = random.Random(5)
    for bins in (1, 2, 7, 40):
        packer, open_, made = packing.Packer(50, bins), {}, 0
        for _ in range(3000):
            length = rng.choice([rng.randint(1, 50), rng.randint(1, 9)])
            fitting = [free for free in open_.values() if free >= length]
            sequence, offset = packer.place(length)
            if fitting:
                assert open_[sequence] == min(fitting) == 50 - offset
            else:
                assert (sequence, offset) == (made, 0)
                made += 1
                if length < 50 and len(open_) == bins:
                    fullest = min(open_.values())
                    closed = [s for s, free in open_.items() if free == fullest and s not in packer.bins[fullest]]
                    del open_[closed[0]]
                open_[sequence] = 50
            open_[sequence] -= length
            if not open_[sequence]:
                del open_[sequence]
            held = {s: free for free, stack in enumerate(packer.bins) for s in stack}
            assert held == open_ and packer.n_open == len(open_) <= bins
            assert packer.free == sum(1 << free for free in set(open_.values()))


def test_odd_rows(odd, plain):
    rows = packing.pack(odd, PATH, size=64, open_bins=2).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    by_piece = {}
    for r in rows:
        by_piece.setdefault((r.id, r.piece), []).append(r)
    assert len(by_piece[1, 0]) == 2 and len(by_piece[None, 0]) == 2  # repeated rows and ids, null ids
    for doc in (3, 4, 5):
        assert [(r.length, r.start, bytes(r.ids)) for r in by_piece[doc, 0]] == [(1, 0, b"\0\0\0\0")]
    single = [r for r in rows if r.id not in (1, None)]
    for doc in {r.id for r in single}:
        pieces = sorted((r for r in single if r.id == doc), key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in pieces) == np.array(plain(texts[doc]), "<u4").tobytes()


def test_no_rows(no_rows):
    assert packing.pack(no_rows, PATH).collect() == []


def test_sequences_hold_the_ids(documents):
    packed = packing.pack(documents, PATH)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert bytes(whole[r.sequence_id].ids)[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert all(len(r.ids) == 4 * r.length <= 4 * packing.SIZE for r in whole.values())
