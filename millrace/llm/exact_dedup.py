"""Exact dedup with a heavy-hitter split.

Texts are equal when identical after lower-casing A-Z; their SHA-256 stands for them. Misra-Gries counters, kept per
partition and added up, name every digest that may have more than a given share of the rows. A second pass counts just
those and finds the row of each that stays; this table has at most ``COUNTERS`` rows and is broadcast, so that the copies
of a frequent text are decided where they are read and never meet in one task. All other digests are shuffled as usual.

Defined results: null text counts as empty, so null and empty texts are copies of one another. Of equal texts the row with
the largest doc_id stays; a null doc_id is smaller than any other. Rows that agree in doc_id and text are repeats: one
stays. A table without rows gives none. Extra columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import settle

# Counters per partition; a digest with more than 2 / (COUNTERS + 1) of all rows is surely found.
COUNTERS = 1024


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [hashlib.sha256((t or "").encode().lower()).digest() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())], ["row", "digest"])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Misra-Gries, a batch at a time: counts are added, then the (COUNTERS + 1)-th largest is taken off all."""
    counts: Counter = Counter()
    rows = 0
    for batch in batches:
        rows += batch.num_rows
        counts.update(batch.column(0).to_pylist())
        if len(counts) > COUNTERS:
            least = sorted(counts.values(), reverse=True)[COUNTERS]
            counts = Counter({k: n - least for k, n in counts.items() if n > least})
    if rows:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*counts, None], pa.binary()),
                pa.array([*counts.values(), rows], pa.int64()),
            ],
            ["digest", "n"],
        )


def with_digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns ``row`` (a struct of all columns of ``docs``) and ``digest``."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("body"))
    schema = packed.select("row", F.lit(b"").alias("digest")).schema
    return packed.mapInArrow(_digest_batches, schema)


def frequent(digests: DataFrame) -> DataFrame:
    """Candidates: at most ``COUNTERS`` digests, among them all that have more than 2 / (COUNTERS + 1) of the rows.

    A partition undercounts a digest by at most 1 / (COUNTERS + 1) of its rows. The added counts are at most the number of
    rows, so fewer than COUNTERS + 1 of them exceed that share.
    """
    counted = digests.select("digest").mapInArrow(_count_batches, "digest binary, n long")
    counted = settle(counted.groupBy("digest").agg(F.sum("n").alias("n")), "frequent")
    rows = counted.where("digest IS NULL").select(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # With rows / (COUNTERS + 1) below 1 every repeated digest would do; a digest of one row is never heavy.
    least = max(1, rows // (COUNTERS + 1))
    return counted.where(F.col("digest").isNotNull() & (F.col("n") > least)).select("digest")


def winners(digests: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates' exact counts and largest ids; ``digests`` has columns id and digest."""
    met = digests.join(F.broadcast(candidates), "digest")
    return settle(met.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")), "winners")


def decide(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    hashed = with_digest(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).select("id", "text"))
    digests = settle(hashed.select("row.id", "digest"), "digests")
    heavy = winners(digests, frequent(digests))
    # Of repeated rows of the winner one stays; they carry equal columns, so any one does.
    heavy_rows = digests.join(F.broadcast(heavy), "digest")
    best = heavy_rows.where(F.col("id").eqNullSafe(F.col("keep_id")))
    losers = heavy_rows.where(~F.col("id").eqNullSafe(F.col("keep_id"))).withColumn("kept", F.lit(False))
    one = best.groupBy("digest", "id", "keep_id", "group_size").agg(F.count("*").alias("n"))
    repeats = one.select(
        "digest", "id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("k")
    )
    best = repeats.withColumn("kept", F.col("k") == 1).drop("k")
    rest = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    same = Window.partitionBy("digest")
    light = rest.select(
        "digest",
        "id",
        F.max("id").over(same).alias("keep_id"),
        F.count("*").over(same).alias("group_size"),
        (F.row_number().over(same.orderBy(F.col("id").desc_nulls_last())) == 1).alias("kept"),
    )
    columns = ["digest", "id", "keep_id", "group_size", "kept"]
    all_rows = light.select(columns).unionByName(losers.select(columns)).unionByName(best.select(columns))
    return all_rows.select("id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, whole. Copies of frequent texts go where they are read; Spark limits each digest to one row
    per task before it shuffles the others."""
    digests = settle(
        with_digest(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))).select("row.id", "digest"), "digests"
    )
    heavy = winners(digests, frequent(digests)).select("digest", F.col("keep_id").alias("_keep"), F.lit(True).alias("_heavy"))
    hashed = with_digest(docs, text).join(F.broadcast(heavy), "digest", "left")
    rows = hashed.where(F.col("_heavy").isNull() | F.col(f"row.{doc_id}").eqNullSafe(F.col("_keep")))
    order = Window.partitionBy("digest").orderBy(F.col(f"row.{doc_id}").desc_nulls_last())
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").select("row.*")


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       row_number() OVER (PARTITION BY s ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, s AS text_sha256
FROM d
"""
