from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def truth(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_minimal_perfect_hash(ranks):
    keys = list(ranks)
    hashed = bpe.MinimalPerfectHash(keys)
    assert sorted(map(hashed, keys)) == list(range(len(keys)))
    assert all(-1 <= hashed(b"not a key %d" % i) < len(keys) for i in range(1000))
    assert bpe.MinimalPerfectHash([])(b"x") == -1


def test_random_texts(ranks, truth):
    one = bpe.Codec(ranks, public_tokenizers.PATTERN)
    draw = random.Random(3)
    letters = "ab  \n\t'sé漢字１2²½.,!  \u0085\x1c\x0b🙂ẞ́dtre'll<|endoftext|>"
    for _ in range(5000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(16)))
        ids = one.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == truth.encode_ordinary(text), repr(text)
        assert one.decode(ids) == text.encode()


def test_small_memory(ranks, truth, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 4)
    one = bpe.Codec(ranks, public_tokenizers.PATTERN)
    text = "several words that come, several times; several words that come again " * 5
    assert np.frombuffer(one.encode(text), "<u4").tolist() == truth.encode_ordinary(text)


def test_long_pre_token(ranks, truth):
    one = bpe.Codec(ranks, public_tokenizers.PATTERN)
    text = "".join(random.Random(4).choice("abcdefgh") for _ in range(20_000))
    assert np.frombuffer(one.encode(text), "<u4").tolist() == truth.encode_ordinary(text)


def check(docs, truth):
    got = sorted(map(tuple, bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect()), key=repr)
    want = []
    for row in docs.select("doc_id", "text").collect():
        text = row["text"] or ""
        ids = truth.encode_ordinary(text)
        data = np.array(ids, "<u4").tobytes()
        want.append((row["doc_id"], len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_documents(documents, truth):
    check(documents, truth)


def test_odd_rows(odd, no_rows, truth):
    check(odd, truth)
    check(no_rows, truth)
