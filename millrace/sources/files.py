"""Bounded and monitored file sources, and the sinks of a streaming query."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable
from contextlib import nullcontext
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from millrace.session import few_partitions, fresh_path
from millrace.sources.wire import PROCESSING_EVENT_WIRE, processing_events


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A bounded in-memory input."""
    return spark.createDataFrame(list(rows), schema)


def watch_json(spark: SparkSession, folder: str, schema: str, max_files: int | None = None) -> DataFrame:
    """New files of a folder, one JSON object per line; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def watch_processing_events(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    return processing_events(watch_json(spark, folder, PROCESSING_EVENT_WIRE, max_files))


def watch_parquet(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """New parquet files of a folder, or of what a pattern matches; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _writer(stream: DataFrame, checkpoint: str | None, mode: str = "append") -> DataStreamWriter:
    checkpoint = checkpoint or fresh_path(stream.sparkSession, "query")
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)


def to_console(stream: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
    return _writer(stream, checkpoint).format("console").option("truncate", False).start()


def to_nowhere(stream: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
    """Runs the query and discards its rows."""
    return _writer(stream, checkpoint).format("noop").start()


def to_memory(stream: DataFrame, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Rows into a table of the driver; for tests."""
    return _writer(stream, checkpoint).format("memory").queryName(name).start()


def to_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str | None = None
) -> StreamingQuery:
    return _writer(stream, checkpoint).foreachBatch(handle).start()


def run_to_branches(
    stream: DataFrame, branches: dict[str, Callable[[DataFrame], DataFrame]], checkpoint: str | None = None
) -> dict[str, DataFrame]:
    """Process all input there is; each branch makes its own rows of every micro-batch, which go to its own table.

    A micro-batch writes to its own folder of each table and replaces what a failed attempt left there, so a restart with the
    same checkpoint neither loses nor repeats rows. Each branch reads the micro-batch for itself; nothing is held in memory.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or fresh_path(spark, "query")
    tables = {name: f"{checkpoint}-{name}" for name in branches}
    empty = spark.createDataFrame([], stream.schema)
    schemas = {name: branch(empty).schema for name, branch in branches.items()}

    def write(batch: DataFrame, batch_id: int) -> None:
        for name, branch in branches.items():
            branch(batch).write.mode("overwrite").parquet(f"{tables[name]}/batch_id={batch_id}")

    query = _writer(stream, checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    for name, schema in schemas.items():
        # A branch that got no micro-batch has a table, too.
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tables[name]}/batch_id=-1")
    return {name: spark.read.schema(schemas[name]).parquet(path).drop("batch_id") for name, path in tables.items()}


def run_to_table(stream: DataFrame, folder: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process all input there is, write the result to the shared folder and return it as a table.

    The file sink commits each micro-batch once, so a restart with the same checkpoint neither loses nor repeats rows.
    Its output stays with the checkpoint, beside which it lies unless a folder is given.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or fresh_path(spark, "query")
    folder = folder or f"{checkpoint}-table"
    query = _writer(stream, checkpoint).format("parquet").trigger(availableNow=True).start(folder)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)


class DroppedRows(RuntimeError):
    """The query dropped rows behind its watermark."""


class Losses(StreamingQueryListener):
    """Adds up the rows that queries dropped behind their watermark, over all of their progress reports.

    A query itself remembers only its last reports.
    """

    WAIT_SECONDS = 60

    def __init__(self) -> None:
        self.rows: Counter[str] = Counter()
        self.ended: defaultdict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.rows[str(progress.runId)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def of(self, query: StreamingQuery) -> int:
        """What a stopped query dropped in all. Reports come in order, so all have come when its end has."""
        run = str(query.runId)
        if not self.ended[run].wait(self.WAIT_SECONDS):
            raise RuntimeError("the end of the query was not reported")
        return self.rows[run]


def run_fed(
    stream: DataFrame, feeds: Iterable[Callable[[], None]], checkpoint: str | None = None, partitions: int | None = None
) -> tuple[DataFrame, int]:
    """Process all input there is, then call the ``feeds`` one by one, each of which adds input, and process that.

    Returns the result and the number of rows that were dropped behind a watermark. ``partitions`` bounds those of the query's
    state, the feeds keep the session's.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or fresh_path(spark, "query")
    folder = f"{checkpoint}-table"
    losses = Losses()
    spark.streams.addListener(losses)
    try:
        writer = _writer(stream, checkpoint).format("parquet")
        with nullcontext() if partitions is None else few_partitions(spark, partitions):
            query = writer.start(folder)
        try:
            query.processAllAvailable()
            for feed in feeds:
                feed()
                query.processAllAvailable()
        finally:
            query.stop()
        lost = losses.of(query)
    finally:
        spark.streams.removeListener(losses)
    return spark.read.schema(stream.schema).parquet(folder), lost


def run_to_end(stream: DataFrame, end: Callable[[], None], partitions: int | None = None) -> DataFrame:
    """Process all input there is, call ``end``, which adds the row that ends the input, process that, and return the result.

    A row that the watermark dropped makes it fail: what comes back would not be the result of the input.
    """
    result, lost = run_fed(stream, [end], partitions=partitions)
    if lost:
        raise DroppedRows(f"{lost} rows were behind the watermark")
    return result
