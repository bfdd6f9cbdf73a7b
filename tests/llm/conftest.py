from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
# Columns whose names operators might use inside.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, id long, digest string, row string, _row string, quality int, size int, rank double, v int, kept string"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, and names that clash."""
    long = " ".join(f"w{i % 9973}x{i // 7}" for i in range(60_000)) + "."
    prose = "The first line of a document has several words, and ends well.\nThe second line has others, and ends well, too."
    rows = [
        (1, prose, "en", "a"),
        (1, prose, "en", "a"),
        (2, prose.upper(), "en", None),
        (3, None, "en", "a"),
        (4, "", None, "b"),
        (5, " \t\n\x0b\x0c\r ", "en", "b"),
        (6, long, "en", "b"),
        (7, long.replace("w5x1 ", "changed "), "en", "b"),
        (None, prose, "en", "c"),
        (None, None, None, None),
        (8, "word", "en", "a"),
        (9, "É é ß 漢字 🙂   x y", "fr", "a"),
        (10, "one two three four", "en", "c"),
        (11, "one two three four", "en", "c"),
    ]
    rest = (5, 6, "d", "r", "q", 1, 2, 0.5, 3, "k")
    return spark.createDataFrame([r + rest[:1] + rest[1:] for r in rows], CLASHING).coalesce(2)


@pytest.fixture(scope="session")
def no_rows(odd):
    return odd.limit(0)
