from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from millrace.llm import language


def grams(samples):
    counts = defaultdict(int)
    for lang, text in samples:
        x = language._bytes(text)
        for i in range(language.ORDER, len(x)):
            gram = int.from_bytes(bytes(x[i - language.ORDER : i + 1]), "big")
            counts[lang, gram] += 1
    return pd.DataFrame([(k, g, n) for (k, g), n in counts.items()], columns=["lang", "gram", "n"])


def brute_bits(samples, lang, text):
    """Method C with exclusion, one byte at a time, from counts kept as dictionaries."""
    trees = defaultdict(lambda: defaultdict(int))
    union = set()
    for k, sample in samples:
        x = bytes(language._bytes(sample))
        for i in range(language.ORDER, len(x)):
            for d in range(language.ORDER + 1):
                union.add(x[i - d : i])
                if k == lang:
                    trees[x[i - d : i]][x[i]] += 1
    x, bits = bytes(language._bytes(text)), 0.0
    for i in range(language.ORDER, len(x)):
        out = set()
        for d in range(language.ORDER, -1, -1):
            seen = {s: n for s, n in trees.get(x[i - d : i], {}).items() if s not in out}
            total, kinds = sum(seen.values()), len(seen)
            if x[i] in seen:
                bits -= math.log2(seen[x[i]] / (total + kinds))
                break
            if total:
                bits -= math.log2(kinds / (total + kinds))
            out |= set(seen)
        else:
            bits += math.log2(256 - len(out))
    return bits


SAMPLES = [("x", "abracadabra abra"), ("x", "cadabra"), ("y", "lorem ipsum dolor lorem"), ("y", "été ñ")]


def test_code_lengths_are_exact():
    model = language.Model(grams(SAMPLES))
    for text in ("abra", "lorem cadabra", "zzz?", "é", "", "abracadabra" * 50, "ipsumté\x00"):
        for k, lang in enumerate(model.langs):
            assert math.isclose(model.lengths(text)[k], brute_bits(SAMPLES, lang, text), rel_tol=1e-4, abs_tol=1e-3), (text, lang)


def test_smaller_table_still_predicts(monkeypatch):
    monkeypatch.setattr(language, "TABLE_BYTES", 8_000)
    model = language.Model(grams(SAMPLES))
    assert model.cost.nbytes <= 8_000
    assert model.predict("abra cadabra")[0] == "x" and model.predict("dolor lorem")[0] == "y"


def test_undecided():
    model = language.Model(grams(SAMPLES))
    for text in (None, "", " 12 ?!", "²½"):
        assert model.predict(text) == ("und", 0.0)
    empty = language.Model(grams([]))
    assert empty.predict("abc") == ("und", 0.0)
    assert np.isfinite(model.lengths("漢字🙂" * 1000)).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.predict_folds(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_odd_rows(odd, no_rows):
    got = language.predict_folds(odd).collect()
    assert len(got) == odd.count()
    assert all(r["lang_pred"] in ("und", "en", "fr") for r in got)
    assert language.predict_folds(no_rows).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.predict_folds(unlabelled).collect()} == {"und"}
