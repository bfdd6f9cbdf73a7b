from __future__ import annotations

import json
import os
import sys
import uuid
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "millrace-tests")
    # State stores and Python workers are per partition; the data is tiny.
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """A UTC instant from ``2026-01-30 12:00:00[.fff]``, without zone as Spark gives it back."""
    return datetime.fromisoformat(text)


def millis(ts: datetime) -> int:
    return int((ts.replace(tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(milliseconds=1))


def wire_line(ts: datetime, line: int, station: int, unit: int, action: str) -> str:
    seconds = str(Decimal(millis(ts)) / 1000)
    return json.dumps(
        {"timestamp": float(seconds), "line": line, "station": station, "unitId": unit, "action": action}
    )


class Player:
    """Feeds a streaming query file by file, each file a micro-batch, and tells what came out of each step."""

    def __init__(self, spark, tmp_path: Path, schemas: dict[str, str]) -> None:
        self.spark = spark
        self.schemas = schemas
        self.folders = {name: tmp_path / f"{name}-{uuid.uuid4().hex}" for name in schemas}
        for folder in self.folders.values():
            folder.mkdir(parents=True)
        self.checkpoint = str(tmp_path / f"checkpoint-{uuid.uuid4().hex}")
        self.table = f"out_{uuid.uuid4().hex}"
        self.query = None

    def stream(self, name: str):
        return self.spark.readStream.schema(self.schemas[name]).json(str(self.folders[name]))

    def start(self, result) -> None:
        self.columns = result.columns
        self.query = (
            result.writeStream.format("memory")
            .queryName(self.table)
            .option("checkpointLocation", self.checkpoint)
            .outputMode("append")
            .start()
        )

    def feed(self, **files: list[dict]) -> list:
        """Write the files, run what they cause, and return all rows so far."""
        for name, rows in files.items():
            text = "\n".join(json.dumps({k: str(v) if isinstance(v, datetime) else v for k, v in r.items()}) for r in rows)
            hidden = self.folders[name] / f".{uuid.uuid4().hex}"
            hidden.write_text(text)
            hidden.rename(self.folders[name] / f"{uuid.uuid4().hex}.json")
        self.query.processAllAvailable()
        return self.spark.table(self.table).collect()

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()


@pytest.fixture
def player(spark, tmp_path):
    made = []

    def make(**schemas: str) -> Player:
        made.append(Player(spark, tmp_path, schemas))
        return made[-1]

    yield make
    for one in made:
        one.stop()
