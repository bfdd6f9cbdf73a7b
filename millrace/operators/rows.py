"""Row-wise operators: filters, fan-out, even redistribution, chained steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import digit_count, letter_count
from millrace.schemas import OUT

# The tags of the two copies.
FIRST, SECOND = "emitted first time", "emitted second time"


def out_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("action") == OUT)


def finished_units(events: DataFrame, stations: int) -> DataFrame:
    """OUT events of the last station: one per unit that leaves the line."""
    return events.where((F.col("station") == stations - 1) & (F.col("action") == OUT))


def emit_twice(df: DataFrame, tag: str = "tag") -> DataFrame:
    """Each row twice, with a tag that tells the copies apart."""
    return df.withColumn(tag, F.explode(F.array(F.lit(FIRST), F.lit(SECOND))))


def doubled(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column) * 2)


def set_constant(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def expect_then_set(df: DataFrame, column: str, expected: str, value: str) -> DataFrame:
    """Replace the column, failing the job on any row that does not hold ``expected``."""
    message = F.concat(F.lit(f"{column} should be {expected}, is "), F.coalesce(column, F.lit("null")))
    checked = F.when(F.col(column) == expected, F.lit(value)).otherwise(F.raise_error(message))
    return df.withColumn(column, checked)


def fan_out(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Set ``foo``, then two independent branches that each still see it and set ``bar`` and ``baz``."""
    parent = set_constant(set_constant(df, column, "process"), column, "foo")
    return expect_then_set(parent, column, "foo", "bar"), expect_then_set(parent, column, "foo", "baz")


def fan_out_tagged(df: DataFrame, column: str, key: str) -> DataFrame:
    """The two branches as tagged rows of one pass: each row's value is set from its key, goes to both branches, and is
    replaced there by the branch's name once it is found unchanged."""
    value = F.concat(F.lit("foo "), F.col(key).cast("string"))
    both = df.withColumn(column, value).withColumn("_branch", F.explode(F.array(F.lit("bar"), F.lit("baz"))))
    message = F.concat(F.lit(f"{column} should be set, is "), F.coalesce(column, F.lit("null")))
    seen = F.when(F.col(column).eqNullSafe(value), F.col("_branch")).otherwise(F.raise_error(message))
    return both.withColumn(column, seen).drop("_branch")


def pass_through(df: DataFrame) -> DataFrame:
    return df.select("*")


def spread_evenly(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows unchanged, spread without regard to keys.

    With a number: round robin. Without: partitions sized by AQE, so that a large input gets more of them.
    """
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def connect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two streams as one, told apart by ``side`` (0 left, 1 right); columns the other lacks are null."""
    return left.withColumn("side", F.lit(0)).unionByName(
        right.withColumn("side", F.lit(1)), allowMissingColumns=True
    )


def keyed_steps(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Run steps that work on the same key one after another.

    No repartition is asked for. Steps that need the key (windows, aggregates on it) share the one exchange Catalyst
    plans for the first of them; steps that do not, such as ``count_step``, need none at all, so that a hot key costs
    nothing.
    """
    for step in steps:
        df = step(df)
    return df


def count_step(text: str, letters: str, digits: str) -> Callable[[DataFrame], DataFrame]:
    """A step that adds the letters and digits of one text column."""
    return lambda df: df.withColumns({letters: letter_count(text), digits: digit_count(text)})
