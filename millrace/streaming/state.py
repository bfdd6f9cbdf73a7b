"""Keyed state of a stopped query as a table: read it, list it, carry it into a new query."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.streaming.stations import COUNT_STATE, INSIDE_STATE, STATS_STATE, station_report


def read_value_state(
    spark: SparkSession, checkpoint: str, variable: str, operator_id: int = 0, batch_id: int | None = None
) -> DataFrame:
    """One row per key that holds a value: key columns, value columns, ``partition_id``."""
    return _read(spark, checkpoint, variable, operator_id, batch_id).select("key.*", "value.*", "partition_id")


def read_map_state(
    spark: SparkSession, checkpoint: str, variable: str, operator_id: int = 0, batch_id: int | None = None
) -> DataFrame:
    """One row per map entry: key columns, entry key, entry value, ``partition_id``."""
    return _read(spark, checkpoint, variable, operator_id, batch_id).select(
        "key.*", "user_map_key.*", "user_map_value.*", "partition_id"
    )


def read_list_state(
    spark: SparkSession, checkpoint: str, variable: str, operator_id: int = 0, batch_id: int | None = None
) -> DataFrame:
    """One row per list element: key columns, element columns, ``partition_id``."""
    return _read(spark, checkpoint, variable, operator_id, batch_id).select("key.*", "list_element.*", "partition_id")


def _read(
    spark: SparkSession, checkpoint: str, variable: str, operator_id: int, batch_id: int | None
) -> DataFrame:
    reader = (
        spark.read.format("statestore")
        .option("path", checkpoint)
        .option("operatorId", operator_id)
        .option("stateVarName", variable)
    )
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load()


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Stateful operators of a query with the number of their partitions and the batches that can be read."""
    return spark.read.format("state-metadata").load(checkpoint)


_PROPERTIES = (
    "timeMode STRING, stateVariables ARRAY<STRUCT<stateName: STRING, stateVariableType: STRING, ttlEnabled: BOOLEAN>>"
)
TIMERS = "timers"


def variables(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a query keeps: operator_id, operator, variable, kind.

    A processor has one row per variable and one for its timers, if it can have any; a stream-stream join one per side; other
    operators one row with ``state`` as variable.
    """
    known = operators(spark, checkpoint).select(
        F.col("operatorId").alias("operator_id"),
        F.col("operatorName").alias("operator"),
        "stateStoreName",
        F.from_json("operatorProperties", _PROPERTIES).alias("p"),
    )
    named = F.filter("p.stateVariables", lambda v: ~v["stateName"].startswith("$"))
    own = F.transform(named, lambda v: F.struct(v["stateName"].alias("variable"), v["stateVariableType"].alias("kind")))
    timers = F.array(F.struct(F.lit(TIMERS).alias("variable"), F.lit("Timers").alias("kind")))
    side = F.regexp_extract("stateStoreName", "^(left|right)-", 1)
    built_in = F.array(
        F.struct(
            F.when(side != "", side).otherwise(F.lit("state")).alias("variable"),
            F.when(side != "", F.lit("JoinSide")).otherwise(F.lit("BuiltIn")).alias("kind"),
        )
    )
    kept = (
        F.when(F.col("p.stateVariables").isNull(), built_in)
        .when(F.col("p.timeMode") != "NoTime", F.concat(own, timers))
        .otherwise(own)
    )
    return known.select("operator_id", "operator", F.explode(kept).alias("v")).select("operator_id", "operator", "v.*").distinct()


_OPTION = {"JoinSide": "joinSide", "BuiltIn": None, "Timers": "readRegisteredTimers"}
# What the reader calls a key, an entry within a key and a value, by kind of variable.
_COLUMNS = {
    "MapState": ("key", "user_map_key", "user_map_value"),
    "ListState": ("key", None, "list_element"),
    "Timers": ("key", None, "expiration_timestamp_ms"),
}


def _text(table: DataFrame, column: str | None) -> Column:
    if column is None:
        return F.lit(None).cast("string")
    kind = table.schema[column].dataType
    if not isinstance(kind, T.StructType):
        return F.col(column).cast("string")
    # Rows of a join's side hold a field that the reader's schema doesn't tell, so the fields are taken by name.
    named = F.struct(*(F.col(column).getField(f.name).alias(f.name) for f in kind))
    return F.when(F.col(column).isNotNull(), F.to_json(named, {"ignoreNullFields": "false"}))


def _tables(spark: SparkSession, checkpoint: str, extra: dict[str, str], also: list[str]) -> DataFrame:
    """All variables under each other; there are as many as the query's text names."""
    tables = []
    for row in variables(spark, checkpoint).orderBy("operator_id", "variable").collect():
        reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", row.operator_id).options(**extra)
        option = _OPTION.get(row.kind, "stateVarName")
        if option is not None:
            reader = reader.option(option, "true" if row.kind == "Timers" else row.variable)
        if row.kind == "ListState":
            # One row per element.
            reader = reader.option("flattenCollectionTypes", "true")
        key, entry, value = _COLUMNS.get(row.kind, ("key", None, "value"))
        table = reader.load()
        text = [_text(table, column).alias(name) for name, column in (("key", key), ("entry", entry), ("value", value))]
        place = [F.lit(row.operator_id).alias("operator_id"), F.lit(row.operator).alias("operator"), F.lit(row.variable).alias("variable")]
        tables.append(table.select(*place, *also, *text, "partition_id"))
    if not tables:
        raise ValueError(f"no state in {checkpoint}")
    return reduce(DataFrame.unionAll, tables)


def dump(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """All that a query keeps, after its last or the named micro-batch: operator_id, operator, variable, key, entry, value, partition_id.

    Keys, entries (the key within a map) and values are JSON with all fields, so that different variables fit one table; a
    timer's value is its time in milliseconds. Nothing is held by the driver but the variables' names.
    """
    return _tables(spark, checkpoint, {} if batch_id is None else {"batchId": str(batch_id)}, [])


def changes(spark: SparkSession, checkpoint: str, first_batch: int = 0, last_batch: int | None = None) -> DataFrame:
    """What the micro-batches wrote and deleted: the columns of ``dump`` with ``batch_id`` and ``change_type`` after ``variable``.

    For queries without stream-stream joins and timers, whose changes Spark can't read.
    """
    bounds = {"readChangeFeed": "true", "changeStartBatchId": str(first_batch)}
    if last_batch is not None:
        bounds["changeEndBatchId"] = str(last_batch)
    return _tables(spark, checkpoint, bounds, ["batch_id", "change_type"])


def file_sizes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Files and bytes of the state of each operator and partition; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{checkpoint}/state")
    place = r"/state/(\d+)/(\d+)/"
    return (
        files.where(F.col("path").rlike(place))
        .groupBy(
            F.regexp_extract("path", place, 1).cast("bigint").alias("operatorId"),
            F.regexp_extract("path", place, 2).cast("int").alias("partition_id"),
        )
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def inventory(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per operator: name, partitions, bytes of state."""
    sizes = file_sizes(spark, checkpoint).groupBy("operatorId").agg(F.sum("bytes").alias("bytes"))
    known = operators(spark, checkpoint).select("operatorId", "operatorName", "numPartitions").distinct()
    return known.join(sizes, "operatorId", "left")


def station_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The counts a running station count was stopped with."""
    return read_value_state(spark, checkpoint, COUNT_STATE).where(F.col("unit_count").isNotNull()).drop("partition_id")


def as_station_stats(counts: DataFrame) -> DataFrame:
    """The count state in the layout of the duration report: smallest and largest time not yet known."""
    unknown = F.lit(None).cast("bigint")
    return counts.withColumns({"min_duration_ms": unknown, "max_duration_ms": unknown})


def resume_as_report(events: DataFrame, count_checkpoint: str, tie: str | None = None) -> DataFrame:
    """A duration report that continues the counts of a stopped running count; run it with a new checkpoint.

    A unit whose IN came before the hand-over is skipped, as its time of arrival is unknown.
    """
    stats = as_station_stats(station_counts(events.sparkSession, count_checkpoint))
    return station_report(events, tie, initial_counts=stats)


def station_stats(spark: SparkSession, checkpoint: str) -> DataFrame:
    return read_value_state(spark, checkpoint, STATS_STATE)


def units_inside(spark: SparkSession, checkpoint: str) -> DataFrame:
    return read_map_state(spark, checkpoint, INSIDE_STATE)
