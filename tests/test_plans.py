"""The plans are the ones wanted: few exchanges, pruned scans, no Python in batch queries."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.plans import catalog, views
from millrace.operators import asof, counts, durations, pairing
from millrace.plans.energy import energy_per_unit
from tests.conftest import SF_DIR

# Aggregates of one's own add and merge in Python.
OWN_AGGREGATES = {"busy_time_per_day"}
BATCH = [n for n in catalog.QUERIES if not n.startswith(("stream_", "state_"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|[Rr]ound|[Ss]ingle)", plan(df)))


@pytest.mark.parametrize("name", BATCH)
def test_batch_queries_stay_in_the_jvm(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|ArrowEval|CartesianProduct|NestedLoop", text)
    assert ("InArrow" in text) == (name in OWN_AGGREGATES)


def test_exchanges(spark):
    line, station, meter = (f(spark, SF_DIR) for f in (views.line_events, views.station_events, views.meter))
    of_meter = exchanges(meter)
    assert of_meter == 1
    assert exchanges(counts.units_per_window(line, 2)) == 1
    assert exchanges(asof.asof_join(line, meter, reading_tie="reading_id")) == 1 + of_meter
    assert exchanges(asof.nearest_join(line, meter, reading_tie="reading_id")) == 1 + of_meter
    assert exchanges(pairing.pair_in_out(line)) == 1
    assert exchanges(counts.running_station_count(station)) == 1
    assert exchanges(durations.station_report(station)) == 2
    # Station, visit, unit: three different keys.
    assert exchanges(energy_per_unit(line, meter, 2)) == 3 + of_meter


def test_steps_on_one_key_share_an_exchange(spark):
    assert exchanges(catalog.QUERIES["keyed_window_steps"](spark, SF_DIR)) == 1
    assert plan(catalog.QUERIES["fan_out_two_branches"](spark, SF_DIR)).count("FileScan") == 1


def test_row_queries_do_not_shuffle(spark):
    for name in ("finished_units", "out_events", "emit_twice_and_double", "keyed_steps", "letters_and_digits",
                 "sensor_values", "json_round_trip"):
        assert exchanges(catalog.QUERIES[name](spark, SF_DIR)) == 0, name


def test_scans_read_only_what_is_needed(spark):
    def columns(name):
        read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(catalog.QUERIES[name](spark, SF_DIR)))
        return [sorted(c.split(":")[0] for c in r.split(",")) for r in read]

    assert columns("units_per_window") == [["event_id", "ts"]]
    assert columns("inactivity_buffered") == [["event_id", "ts", "user_id"]]
    assert columns("letters_and_digits") == [["doc_id", "text"]]
    assert columns("energy_per_unit") == [["event_id", "ts"], ["event_id", "ts", "user_id", "value"]]
    assert columns("json_decode") == [["event_id", "props"]]


def test_filters_run_before_the_shuffle(spark):
    text = plan(catalog.QUERIES["units_per_window"](spark, SF_DIR))
    assert text.index("Exchange") < text.index("Filter") and text.index("partial_count") < text.index("Filter")
    boundary = F.lit("2024-01-15").cast("timestamp_ntz")
    text = plan(asof.prune_readings(views.sensor_readings(spark, SF_DIR), boundary))
    assert "GreaterThan(ts" in text and "LessThanOrEqual(ts" in text
