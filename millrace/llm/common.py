"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import fresh_path, ship

# A word is a run of characters other than these six (space and U+0009 to U+000D).
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

# Tables of at most this many narrow rows may be broadcast (about 10 MB); longer ones are joined by shuffle.
BROADCAST_ROWS = 100_000
# What Spark may broadcast by its own estimate, where the operators bound it (``few_broadcasts``).
BROADCAST_BYTES = 256 * 2**10


# Rows go to Python workers in batches of about so many bytes: texts are long, and a batch is held several times.
BATCH_BYTES = 8 * 2**20


def settings(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on and return the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps neither recompute it nor depend on the executors
    that made it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove settled tables that no later step reads: what was made from them must be settled itself."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._settled_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Steps run within remove their shuffle files when they end, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def few_broadcasts(spark: SparkSession) -> Iterator[None]:
    """In steps run within, Spark broadcasts by its own estimate only what it takes for very small.

    It sizes a settled table by its compressed files, and rows made by ``explode`` as if each array had one element, so what it
    takes for 10 MB may be a table of hashes of many times that, which the driver collects, builds and keeps. Joins that ask for a
    broadcast still get it (``join_small``).
    """
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    allowed = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    try:
        for name in names:
            spark.conf.set(name, str(min(allowed, BROADCAST_BYTES)))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where a lambda inside ``body`` uses it for each element."""
    return F.transform(F.array(value), body)[0]


def join_small(big: DataFrame, small: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join with a settled table of unique keys: broadcast while its row count is within ``BROADCAST_ROWS``.

    Beyond it, both sides are shuffled by key and a salt; ``small`` is repeated for each salt, so that a key with a large
    share of ``big`` is met by several tasks.
    """
    if small.count() <= BROADCAST_ROWS:  # of a settled table: read from the footers of its files
        return big.join(F.broadcast(small), key, how)
    salts = 32
    salted = big.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    each = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(each, [key, "_salt"], how).drop("_salt")
