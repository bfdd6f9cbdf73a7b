"""The pipeline's stages on a small table, each against brute force on what the stage before it kept."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from millrace.llm import bpe
from millrace.session import fresh_path
from tests.llm import test_mixing as mixing
from tests.llm import test_near_dup as near_dup
from tests.llm import test_quality as quality
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def tables(spark):
    """What each stage reads, by its name, and the last result."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs
        path = fresh_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return out | {"result": docs}


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_all_but_the_last_keep_the_columns(tables):
    for name in ("exact_dedup", "near_dedup", "mixing", "byte_bpe"):
        assert tables[name].columns == tables["quality_rules"].columns


def test_quality(tables):
    before = {r["doc_id"]: r["text"] for r in tables["quality_rules"].collect()}
    after = {r["doc_id"]: r["text"] for r in tables["exact_dedup"].collect()}
    assert tables["exact_dedup"].count() == len(after) and 0 < len(after) < len(before)
    for i, text in after.items():
        assert not quality.brute(before[i])[-1]
        left = iter(before[i].split("\n"))
        assert all(line in left for line in text.split("\n")), i  # lines went, none changed


def test_exact_dedup(tables):
    last = {}
    for row in tables["exact_dedup"].collect():
        key = (row["text"] or "").encode().lower()
        last[key] = max(last.get(key, row), row, key=lambda r: r["doc_id"])
    assert rows(tables["near_dedup"]) == Counter(map(tuple, last.values()))


def test_near_dedup(tables):
    read = tables["near_dedup"].collect()
    component, _ = near_dup.brute([(r["doc_id"], r["text"]) for r in read], 5)
    assert rows(tables["mixing"]) == Counter(tuple(r) for r in read if component[r["doc_id"]] == r["doc_id"])


def test_mixing(tables):
    read, mixed = tables["mixing"].collect(), rows(tables["byte_bpe"])
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in read:
        size = mixing.size(r["text"])
        sizes[r["source"]] += size
        taken[r["source"]] += size * mixed[tuple(r)]
        longest[r["source"]] = max(longest[r["source"]], size)
        assert mixed[tuple(r)] <= 2
    assert set(mixed) <= {tuple(r) for r in read}
    for source, target in mixing.brute_targets(sizes).items():
        assert abs(taken[source] - target) <= longest[source] / 2 + 1, source


def test_encoding(tables):
    ranks = bpe.load_ranks(corpus_pipeline.VOCABULARY)
    truth = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in tables["byte_bpe"].collect():
        ids = truth.encode_ordinary(r["text"])
        data = np.array(ids, "<u4").tobytes()
        want[r["doc_id"], len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()] += 1
    assert rows(tables["result"]) == want


def test_run_gives_the_last_table(spark, tables):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(tables["result"])
