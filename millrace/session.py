"""Session settings the package relies on, and the shared folder it writes to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE_ENCODING = "spark.sql.streaming.stateStore.encodingFormat"
CHECKPOINT_DIR = "spark.checkpoint.dir"
PARTITIONS = "spark.sql.shuffle.partitions"

# Settings that can be changed on a running session.
RUNTIME_SETTINGS = {
    # Millisecond outputs and the NTZ -> TIMESTAMP cast of streams must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Of several sources the slowest sets the pace.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    # transformWithState needs column families, hence RocksDB; changelogs keep checkpoints incremental.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Hot keys are merged on the map side before the shuffle of session windows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, wherever they run and whether or not it is installed there; once a context."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("millrace", os.path.relpath(path, root)))
    context.addPyFile(target)
    context._millrace_shipped = True
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    context = spark.sparkContext
    if context.master.startswith("local") and spark.conf.get(PARTITIONS) == "200":
        # The default is meant for a cluster; every partition of a stateful query has a store and a Python worker.
        spark.conf.set(PARTITIONS, str(context.defaultParallelism))
    return spark


@contextmanager
def evolvable(spark: SparkSession) -> Iterator[SparkSession]:
    """Queries started within keep state whose values can get more fields later. A checkpoint stays with its encoding."""
    before = spark.conf.get(STATE_ENCODING, None)
    spark.conf.set(STATE_ENCODING, "avro")
    try:
        yield spark
    finally:
        if before is None:
            spark.conf.unset(STATE_ENCODING)
        else:
            spark.conf.set(STATE_ENCODING, before)


@contextmanager
def few_partitions(spark: SparkSession, most: int) -> Iterator[SparkSession]:
    """Streaming queries started within have at most so many partitions, as each costs a store and a Python worker in every
    micro-batch; with few keys more of them only stay empty."""
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(min(most, int(before))))
    try:
        yield spark
    finally:
        spark.conf.set(PARTITIONS, before)


def local_session(cores: str = "8", app: str = "millrace") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config(PARTITIONS, cores if cores.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; checkpoints and written tables go there.

    A machine-local folder is made only where the setting is absent and the master is local, as in tests.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
    if not configured and not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="millrace-"))
    return configured or context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
