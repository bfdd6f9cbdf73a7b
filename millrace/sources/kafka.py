"""Topics as sources and sinks. The connector jars are the cluster's; these functions only describe the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace import schemas
from millrace.session import fresh_path
from millrace.sources import avro, wire


def source_options(
    servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None, group: str | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if group is not None:
        options["kafka.group.id"] = group
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Key, value and metadata of a topic's messages."""
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **kwargs)).load()


def read_processing_events(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    return wire.decode_processing_events(read_topic(spark, servers, topic, **kwargs))


def read_generic_events(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    return wire.decode_generic_events(read_topic(spark, servers, topic, **kwargs))


def write_topic(
    messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None
) -> DataStreamWriter:
    """A writer of ``key``/``value`` messages (at least once); start it with ``.start()``."""
    return (
        messages.writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint or fresh_path(messages.sparkSession, "query"))
    )


def copy_topic(
    spark: SparkSession, servers: str, source: str, target: str, checkpoint: str | None = None, **kwargs
) -> DataStreamWriter:
    """Generic events from one topic to another, unchanged and keyed by id.

    The steps between keep no state, so there is nothing to shuffle for: the key goes into the message.
    """
    events = read_generic_events(spark, servers, source, **kwargs)
    return write_topic(wire.encode_generic_events(events), servers, target, checkpoint)


def decode_avro(messages: DataFrame, schema_id: int | None = None) -> DataFrame:
    """Processing events from Avro values with a registry's header."""
    record = avro.decode(messages.select("value"), schemas.PROCESSING_EVENT_AVRO, schema_id)
    return wire.events_from_avro(record)


def encode_avro(statistics: DataFrame, schema_id: int) -> DataFrame:
    """Avro values with a registry's header from window counts."""
    records = wire.statistics_to_avro(statistics)
    return records.select(avro.encode(records, schemas.STATISTICS_AVRO_SCHEMA, schema_id).alias("value"))


def read_avro_events(spark: SparkSession, servers: str, topic: str, schema_id: int | None = None, **kwargs) -> DataFrame:
    """Processing events of a topic from its first message on."""
    return decode_avro(read_topic(spark, servers, topic, **{"starting": "earliest", **kwargs}), schema_id)
