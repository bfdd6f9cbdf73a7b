"""The query catalogue: each batch query over the driver tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.records import decode_json, encode_json, energy, temperature
from millrace.functions.text import digit_count, letter_count, total_digits, total_letters
from millrace.functions.time import from_millis, to_millis
from millrace.operators import aggregates, asof, counts, durations, inactivity, pairing, rows
from millrace.plans import views
from millrace.plans.energy import energy_per_unit, station_energy
from millrace.schemas import PROCESSING_EVENT_AVRO, STATISTICS_AVRO_SCHEMA
from millrace.session import prepare
from millrace.sources import avro, kafka, wire

Query = Callable[[SparkSession, str], DataFrame]

STATIONS = views.LINE_STATIONS
INACTIVITY_SECONDS = 3600
LATENESS_SECONDS = 600
DISORDER_SECONDS = 10
# Average milliseconds reach 1e10; with six digits an engine that rounds by scaling would leave the exact integers.
AVERAGE_DIGITS = 3
PRUNE_AT = "2024-01-15 00:00:00"

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return register


LINE_EVENTS = """line_events AS (
  SELECT event_id, ts, CAST((event_id // 4) % 3 AS INTEGER) AS line, CAST((event_id % 4) // 2 AS INTEGER) AS station,
         event_id // 4 AS unit_id, CASE WHEN event_id % 2 = 0 THEN 'IN' ELSE 'OUT' END AS action
  FROM events)"""

STATION_EVENTS = """station_events AS (
  SELECT event_id, ts, CAST((event_id // 2) % 3 AS INTEGER) AS line, CAST((event_id // 2) % 4 AS INTEGER) AS station,
         event_id // 2 AS unit_id, CASE WHEN event_id % 2 = 0 THEN 'IN' ELSE 'OUT' END AS action
  FROM events)"""

VISITOR_EVENTS = """visitor_events AS (
  SELECT event_id, ts, CAST(user_id % 3 AS INTEGER) AS line, CAST((user_id // 3) % 4 AS INTEGER) AS station,
         user_id AS unit_id, CASE WHEN event_id % 2 = 0 THEN 'IN' ELSE 'OUT' END AS action
  FROM events)"""

METER = """meter AS (
  SELECT event_id AS reading_id, ts, CAST(user_id % 3 AS INTEGER) AS line,
         CAST((user_id // 3) % 2 AS INTEGER) AS station,
         sum(value) OVER (PARTITION BY user_id % 3, (user_id // 3) % 2 ORDER BY ts, event_id
                          ROWS UNBOUNDED PRECEDING) AS energy
  FROM events)"""

DELAYED_EVENTS = f"""delayed AS (
  SELECT event_id, line, station, unit_id, action,
         ts - CASE event_id % 7 WHEN 3 THEN INTERVAL 20 MINUTE WHEN 5 THEN INTERVAL 5 MINUTE
              ELSE INTERVAL 0 MINUTE END AS ts
  FROM line_events),
watermarked AS (
  SELECT *, max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - INTERVAL {DISORDER_SECONDS} SECOND AS watermark
  FROM delayed)"""

_WINDOW_START = "time_bucket(INTERVAL 5 MINUTE, ts)"


def _ms(ts: str) -> str:
    """Epoch milliseconds cut, not rounded."""
    return f"(epoch_us({ts}) // 1000)"


# --- Tumbling windows ------------------------------------------------------------------------------------------------


@query(
    "units_per_window",
    f"""WITH {LINE_EVENTS}
SELECT line, {_ms(_WINDOW_START)} AS window_start, {_ms(_WINDOW_START)} + 300000 AS window_end,
       count(*) AS count
FROM line_events WHERE station = {STATIONS - 1} AND action = 'OUT' GROUP BY line, {_WINDOW_START}""",
)
def units_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.in_millis(counts.units_per_window(views.line_events(spark, sf_dir), STATIONS))


@query(
    "units_per_window_timestamps",
    f"""WITH {LINE_EVENTS}
SELECT line, {_WINDOW_START} AS window_start, {_WINDOW_START} + INTERVAL 5 MINUTE AS window_end, count(*) AS count
FROM line_events WHERE station = {STATIONS - 1} AND action = 'OUT' GROUP BY line, {_WINDOW_START}""",
)
def units_per_window_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.units_per_window(views.line_events(spark, sf_dir), STATIONS)


@query(
    "units_per_window_late_dropped",
    f"""WITH {LINE_EVENTS}, {DELAYED_EVENTS}
SELECT line, {_ms(_WINDOW_START)} AS window_start, {_ms(_WINDOW_START)} + 300000 AS window_end,
       count(*) AS count
FROM watermarked WHERE station = {STATIONS - 1} AND action = 'OUT'
  AND (watermark IS NULL OR {_WINDOW_START} + INTERVAL 5 MINUTE > watermark)
GROUP BY line, {_WINDOW_START}""",
)
def units_per_window_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = counts.arrival_watermark(views.delayed(views.line_events(spark, sf_dir)), DISORDER_SECONDS)
    return counts.in_millis(counts.units_per_window(counts.without_late(events), STATIONS))


# --- Joins in time ---------------------------------------------------------------------------------------------------


@query(
    "asof_join",
    f"""WITH {LINE_EVENTS}, {METER}
SELECT e.event_id, e.ts, e.line, e.station, e.unit_id, e.action, r.ts AS reading_ts, round(r.energy, 6) AS energy
FROM line_events e ASOF LEFT JOIN meter r ON e.line = r.line AND e.station = r.station AND e.ts >= r.ts""",
)
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = asof.asof_join(views.line_events(spark, sf_dir), views.meter(spark, sf_dir), reading_tie="reading_id")
    return _flat(joined)


@query(
    "asof_join_with_lateness",
    f"""WITH {LINE_EVENTS}, {DELAYED_EVENTS}, {METER}
SELECT e.event_id, e.ts, e.line, e.station, e.unit_id, e.action, r.ts AS reading_ts, round(r.energy, 6) AS energy
FROM (SELECT * FROM watermarked
      WHERE watermark IS NULL OR ts > watermark - INTERVAL {LATENESS_SECONDS} SECOND) e
ASOF LEFT JOIN meter r ON e.line = r.line AND e.station = r.station AND e.ts >= r.ts""",
)
def asof_join_with_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = counts.arrival_watermark(views.delayed(views.line_events(spark, sf_dir)), DISORDER_SECONDS)
    joined = asof.asof_join_with_lateness(
        events, views.meter(spark, sf_dir), LATENESS_SECONDS, reading_tie="reading_id"
    )
    return _flat(joined).drop("watermark")


@query(
    "pruned_readings",
    f"""WITH {METER}, ranked AS (
  SELECT *, max(ts) FILTER (WHERE ts <= TIMESTAMP '{PRUNE_AT}') OVER (PARTITION BY line, station) AS latest FROM meter)
SELECT reading_id, ts, line, station, round(energy, 6) AS energy FROM ranked
WHERE ts > TIMESTAMP '{PRUNE_AT}' OR ts = latest""",
)
def pruned_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    boundary = F.lit(PRUNE_AT).cast("timestamp_ntz")
    kept = asof.prune_readings(views.meter(spark, sf_dir), boundary)
    return kept.withColumn("energy", F.round("energy", 6))


@query(
    "nearest_join",
    f"""WITH {LINE_EVENTS}, {METER},
b AS (SELECT e.*, r.ts AS b_ts, r.energy AS b_energy FROM line_events e
      ASOF LEFT JOIN meter r ON e.line = r.line AND e.station = r.station AND e.ts >= r.ts),
f AS (SELECT e.event_id, r.ts AS f_ts, r.energy AS f_energy FROM line_events e
      ASOF LEFT JOIN meter r ON e.line = r.line AND e.station = r.station AND e.ts < r.ts),
m AS (SELECT b.*, f.f_ts, f.f_energy, f_ts IS NULL OR (b_ts IS NOT NULL AND ts - b_ts <= f_ts - ts) AS back
      FROM b JOIN f USING (event_id) WHERE b_ts IS NOT NULL OR f_ts IS NOT NULL)
SELECT event_id, ts, line, station, unit_id, action, CASE WHEN back THEN b_ts ELSE f_ts END AS reading_ts,
       round(CASE WHEN back THEN b_energy ELSE f_energy END, 6) AS energy,
       abs({_ms('CASE WHEN back THEN b_ts ELSE f_ts END')} - {_ms('ts')}) AS time_delta_ms
FROM m""",
)
def nearest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = asof.nearest_join(
        views.line_events(spark, sf_dir), views.meter(spark, sf_dir), reading_tie="reading_id"
    )
    return _flat(joined)


def _flat(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {"reading_ts": F.col("reading.ts"), "energy": F.round("reading.energy", 6)}
    ).drop("reading")


@query(
    "connected_streams",
    f"""WITH {LINE_EVENTS}, {METER}, connected AS (
  SELECT line, station, 0 AS side FROM line_events UNION ALL SELECT line, station, 1 AS side FROM meter)
SELECT line, station, count(*) FILTER (WHERE side = 0) AS events, count(*) FILTER (WHERE side = 1) AS readings
FROM connected GROUP BY line, station""",
)
def connected_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = rows.connect(views.line_events(spark, sf_dir), views.sensor_readings(spark, sf_dir))
    return both.groupBy("line", "station").agg(
        F.count_if(F.col("side") == 0).alias("events"), F.count_if(F.col("side") == 1).alias("readings")
    )


# --- Units -----------------------------------------------------------------------------------------------------------

_VISITS = """SELECT line, station, unit_id, max(ts) FILTER (WHERE action = 'IN') AS start_ts,
       max(ts) FILTER (WHERE action = 'OUT') AS end_ts,
       max(event_id) FILTER (WHERE action = 'OUT') AS event_id,
       max(energy) FILTER (WHERE action = 'OUT') - max(energy) FILTER (WHERE action = 'IN') AS energy_consumption
FROM enriched GROUP BY line, station, unit_id
HAVING count(*) FILTER (WHERE action = 'IN') = 1 AND count(*) FILTER (WHERE action = 'OUT') = 1"""

_ENRICHED = """enriched AS (
  SELECT e.*, r.energy FROM line_events e
  ASOF LEFT JOIN meter r ON e.line = r.line AND e.station = r.station AND e.ts >= r.ts)"""


@query(
    "station_visits",
    f"""WITH {LINE_EVENTS}, {METER}, {_ENRICHED}, visits AS ({_VISITS})
SELECT line, station, unit_id, start_ts, end_ts, round(energy_consumption, 6) AS energy_consumption FROM visits""",
)
def station_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = station_energy(views.line_events(spark, sf_dir), views.meter(spark, sf_dir))
    return visits.drop("event_id").withColumn("energy_consumption", F.round("energy_consumption", 6))


@query(
    "sum_per_unit",
    f"""WITH visits AS (
  SELECT event_id, CAST(event_id % 3 AS INTEGER) AS line, user_id AS unit_id, ts,
         CASE WHEN event_type <> 'error' THEN value END AS energy FROM events),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY unit_id ORDER BY ts, event_id) - 1) // {STATIONS} AS chunk FROM visits)
SELECT unit_id, CAST(max_by(line, event_id) AS BIGINT) AS line,
       round(sum(coalesce(energy, 0)), 6) AS energy_consumption
FROM numbered GROUP BY unit_id, chunk HAVING count(*) = {STATIONS}""",
)
def sum_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = views.as_measured_visits(views.table(spark, sf_dir, "events"))
    summed = pairing.sum_per_unit(visits, STATIONS)
    return summed.withColumn("energy_consumption", F.round("energy_consumption", 6))


@query(
    "energy_per_unit",
    f"""WITH {LINE_EVENTS}, {METER}, {_ENRICHED}, visits AS ({_VISITS}),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY end_ts, event_id) AS n FROM visits)
SELECT unit_id, CAST(max_by(line, n) AS BIGINT) AS line,
       round(sum(coalesce(energy_consumption, 0)), 6) AS energy_consumption
FROM numbered GROUP BY unit_id, (n - 1) // {STATIONS} HAVING count(*) = {STATIONS}""",
)
def energy_per_unit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = energy_per_unit(views.line_events(spark, sf_dir), views.meter(spark, sf_dir), STATIONS)
    return summed.withColumn("energy_consumption", F.round("energy_consumption", 6))


# --- Stations --------------------------------------------------------------------------------------------------------


@query(
    "running_station_count",
    f"""WITH {STATION_EVENTS}
SELECT event_id, line, station, unit_id,
       row_number() OVER (PARTITION BY line, station ORDER BY ts, event_id) AS unit_count
FROM station_events WHERE action = 'OUT'""",
)
def running_station_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = counts.running_station_count(views.station_events(spark, sf_dir))
    return counted.select("event_id", "line", "station", "unit_id", "unit_count")


def _report_sql(view: str, name: str, average: str = "") -> str:
    return f"""WITH {view},
steps AS (
  SELECT *, lag(action) OVER v AS last_action, lag(ts) OVER v AS last_ts FROM {name}
  WINDOW v AS (PARTITION BY line, station, unit_id ORDER BY ts, event_id)),
durations AS (
  SELECT *, {_ms('ts')} - {_ms('last_ts')} AS d FROM steps WHERE action = 'OUT' AND last_action = 'IN')
SELECT event_id, line, station, unit_id, count(*) OVER w AS unit_count, min(d) OVER w AS min_duration_ms,
       max(d) OVER w AS max_duration_ms{average}
FROM durations
WINDOW w AS (PARTITION BY line, station ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""


@query("station_report", _report_sql(STATION_EVENTS, "station_events"))
def station_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return durations.station_report(views.station_events(spark, sf_dir)).drop("ts", "avg_duration_ms")


@query(
    "station_report_with_average",
    _report_sql(VISITOR_EVENTS, "visitor_events", f", round(avg(d) OVER w, {AVERAGE_DIGITS}) AS avg_duration_ms"),
)
def station_report_with_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = durations.station_report(views.visitor_events(spark, sf_dir)).drop("ts")
    return report.withColumn("avg_duration_ms", F.round("avg_duration_ms", AVERAGE_DIGITS))


@query(
    "station_durations",
    f"""WITH {VISITOR_EVENTS},
steps AS (
  SELECT *, lag(action) OVER v AS last_action, lag(ts) OVER v AS last_ts FROM visitor_events
  WINDOW v AS (PARTITION BY line, station, unit_id ORDER BY ts, event_id))
SELECT event_id, line, station, unit_id, ts, {_ms('ts')} - {_ms('last_ts')} AS duration_ms
FROM steps WHERE action = 'OUT' AND last_action = 'IN'""",
)
def station_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return durations.station_durations(views.visitor_events(spark, sf_dir))


def _inactivity_sql(comparison: str) -> str:
    return f"""WITH {VISITOR_EVENTS},
gaps AS (
  SELECT *, lead(ts) OVER (PARTITION BY line, station ORDER BY ts, event_id) AS next_ts FROM visitor_events)
SELECT CAST(line AS BIGINT) AS line, CAST(station AS BIGINT) AS station, {_ms('ts')} AS timestamp
FROM gaps WHERE next_ts IS NULL OR next_ts {comparison} ts + INTERVAL {INACTIVITY_SECONDS} SECOND"""


@query("inactivity_in_order", _inactivity_sql(">"))
def inactivity_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inactivity.inactivity_in_order(views.visitor_events(spark, sf_dir), INACTIVITY_SECONDS)


@query("inactivity_buffered", _inactivity_sql(">="))
def inactivity_buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inactivity.inactivity_buffered(views.visitor_events(spark, sf_dir), INACTIVITY_SECONDS)


# --- Rows ------------------------------------------------------------------------------------------------------------


@query(
    "finished_units",
    f"""WITH {LINE_EVENTS}
SELECT event_id, ts, line, station, unit_id, action FROM line_events
WHERE station = {STATIONS - 1} AND action = 'OUT'""",
)
def finished_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.finished_units(views.line_events(spark, sf_dir), STATIONS)


@query(
    "out_events",
    f"WITH {STATION_EVENTS} SELECT event_id, ts, line, station, unit_id, action FROM station_events WHERE action = 'OUT'",
)
def out_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.out_events(views.station_events(spark, sf_dir))


@query(
    "emit_twice_and_double",
    f"""SELECT event_id, user_id * 2 AS user_id, unnest(['{rows.FIRST}', '{rows.SECOND}']) AS tag FROM events""",
)
def emit_twice_and_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id")
    return rows.doubled(rows.emit_twice(events), "user_id")


@query(
    "fan_out_two_branches",
    "SELECT event_id, unnest(['bar', 'baz']) AS event_type FROM events",
)
def fan_out_two_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.fan_out_tagged(views.table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id")


@query("pass_through", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.pass_through(views.table(spark, sf_dir, "events"))


@query("spread_evenly", "SELECT event_id, user_id, value FROM events")
def spread_evenly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.spread_evenly(views.table(spark, sf_dir, "events").select("event_id", "user_id", "value"))


def _letters(column: str) -> str:
    return f"length(regexp_replace({column}, '[^\\p{{L}}]', '', 'g'))"


def _digits(column: str) -> str:
    return f"length(regexp_replace({column}, '[^\\p{{Nd}}]', '', 'g'))"


@query(
    "keyed_steps",
    "SELECT p_partkey, "
    + ", ".join(
        f"CAST({_letters(c)} AS INTEGER) AS letters{i}, CAST({_digits(c)} AS INTEGER) AS digits{i}"
        for i, c in enumerate(["p_name", "p_brand", "p_type"], 1)
    )
    + " FROM part",
)
def keyed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = views.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    steps = [rows.count_step(c, f"letters{i}", f"digits{i}") for i, c in enumerate(["p_name", "p_brand", "p_type"], 1)]
    return rows.keyed_steps(part, steps).drop("p_name", "p_brand", "p_type")


@query(
    "keyed_window_steps",
    f"""SELECT event_id, user_id, row_number() OVER w AS n, {_ms('ts')} - {_ms('coalesce(lag(ts) OVER w, ts)')} AS gap_ms,
       max(value) OVER w AS highest
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def keyed_window_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three steps that each need the key, on one exchange."""
    by_user = Window.partitionBy("user_id").orderBy("ts", "event_id")
    steps = [
        lambda df: df.withColumn("n", F.row_number().over(by_user).cast("bigint")),
        lambda df: df.withColumn("gap_ms", to_millis("ts") - to_millis(F.coalesce(F.lag("ts").over(by_user), "ts"))),
        lambda df: df.withColumn("highest", F.max("value").over(by_user)),
    ]
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return rows.keyed_steps(events, steps).drop("ts", "value")


BUSY_SECONDS = 900


@query(
    "busy_time_per_day",
    f"""WITH {VISITOR_EVENTS},
steps AS (
  SELECT line, station, date_trunc('day', ts) AS window_start, epoch_us(ts) AS us,
         epoch_us(ts) - lag(epoch_us(ts)) OVER w <= {BUSY_SECONDS} * 1000000 AS goes_on
  FROM visitor_events WINDOW w AS (PARTITION BY line, station, date_trunc('day', ts) ORDER BY ts, event_id)),
numbered AS (
  SELECT *, count(*) FILTER (WHERE goes_on IS NOT TRUE) OVER
              (PARTITION BY line, station, window_start ORDER BY us RANGE UNBOUNDED PRECEDING) AS n
  FROM steps),
stretches AS (
  SELECT line, station, window_start, max(us) - min(us) + {BUSY_SECONDS} * 1000000 AS us
  FROM numbered GROUP BY line, station, window_start, n)
SELECT line, station, CAST(window_start AS TIMESTAMP) AS window_start, CAST(sum(us) AS BIGINT) AS busy_us,
       count(*) AS stretches, max(us) AS longest_us
FROM stretches GROUP BY line, station, window_start""",
)
def busy_time_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate of one's own: a station's time within a quarter of an hour after an event, by day."""
    return aggregates.busy_time(views.visitor_events(spark, sf_dir), ["line", "station"], BUSY_SECONDS)


# --- Functions -------------------------------------------------------------------------------------------------------


@query(
    "letters_and_digits",
    f"""SELECT doc_id, CAST({_letters('text')} AS INTEGER) AS letters, CAST({_digits('text')} AS INTEGER) AS digits
FROM documents""",
)
def letters_and_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", letter_count("text").alias("letters"), digit_count("text").alias("digits")
    )


_THREE = ["p_name", "p_brand", "p_type"]


@query(
    "letters_and_digits_of_three",
    f"""SELECT p_partkey, CAST({' + '.join(map(_letters, _THREE))} AS INTEGER) AS letters,
       CAST({' + '.join(map(_digits, _THREE))} AS INTEGER) AS digits FROM part""",
)
def letters_and_digits_of_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "part").select(
        "p_partkey", total_letters(*_THREE).alias("letters"), total_digits(*_THREE).alias("digits")
    )


@query(
    "epoch_millis",
    f"SELECT event_id, {_ms('ts')} AS millis, date_trunc('millisecond', ts) AS ts FROM events",
)
def epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.table(spark, sf_dir, "events")
        .select("event_id", to_millis("ts").alias("millis"))
        .withColumn("ts", from_millis("millis").cast("timestamp_ntz"))
    )


@query(
    "sensor_values",
    """SELECT event_id AS reading_id, CAST(user_id % 3 AS INTEGER) AS line,
       CAST((user_id // 3) % 2 AS INTEGER) AS station, value AS energy, round(value / 10, 6) AS temperature
FROM events""",
)
def sensor_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sensor_readings(spark, sf_dir).select(
        "reading_id",
        "line",
        "station",
        energy("readings").alias("energy"),
        F.round(temperature("readings"), 6).alias("temperature"),
    )


@query(
    "json_decode",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    parsed = F.from_json("props", "k INT", {"mode": "FAILFAST"})
    return events.select("event_id", parsed["k"].alias("k"))


@query(
    "json_encode",
    f"""WITH {STATION_EVENTS}
SELECT '{{"line":' || line || ',"station":' || station || ',"unit_id":' || unit_id || ',"action":"' || action || '"}}'
       AS value
FROM station_events""",
)
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_json(views.station_events(spark, sf_dir).select("line", "station", "unit_id", "action"))


@query(
    "json_round_trip",
    f"WITH {STATION_EVENTS} SELECT line, station, unit_id, action FROM station_events",
)
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_json(views.station_events(spark, sf_dir).select("line", "station", "unit_id", "action"))
    return decode_json(encoded, "line INT, station INT, unit_id BIGINT, action STRING")


# An id as a registry would give it to the schema of the events.
EVENT_SCHEMA_ID, COUNT_SCHEMA_ID = 7, 70_000


def _varint(number: str) -> str:
    """Hexadecimal bytes of a number that is not negative, zig-zag and seven bits a byte."""
    length = " + ".join(f"(2 * ({number}) >= {1 << 7 * i})::INT" for i in range(1, 9))
    return f"""list_aggregate(list_transform(range(1 + {length}), lambda i: printf('%02X',
      (CAST(2 * ({number}) AS BIGINT) >> CAST(7 * i AS INTEGER)) & 127 | CASE WHEN i < {length} THEN 128 ELSE 0 END)), 'string_agg', '')"""


@query(
    "avro_messages",
    f"""WITH {STATION_EVENTS}
SELECT event_id, '00{EVENT_SCHEMA_ID:08X}' || {_varint(_ms('ts'))} || {_varint('line')} || {_varint('station')}
       || {_varint('unit_id')} || {_varint("CASE action WHEN 'IN' THEN 0 ELSE 1 END")} AS message
FROM station_events""",
)
def avro_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of each event's message."""
    events = views.station_events(spark, sf_dir)
    records = events.withColumns({"timestamp": F.col("ts"), "unitId": F.col("unit_id")})
    return records.select("event_id", F.hex(avro.encode(records, PROCESSING_EVENT_AVRO, EVENT_SCHEMA_ID)).alias("message"))


@query(
    "avro_round_trip",
    f"WITH {STATION_EVENTS} SELECT date_trunc('millisecond', ts) AS ts, line, station, unit_id, action FROM station_events",
)
def avro_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = wire.events_to_avro(views.station_events(spark, sf_dir))
    messages = records.select(avro.encode(records, PROCESSING_EVENT_AVRO, EVENT_SCHEMA_ID).alias("value"))
    return kafka.decode_avro(messages, EVENT_SCHEMA_ID).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("avro_units_per_window", SQL["units_per_window"])
def avro_units_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts of events that come as messages, written as messages and read again."""
    records = wire.events_to_avro(views.line_events(spark, sf_dir))
    messages = records.select(avro.encode(records, PROCESSING_EVENT_AVRO, EVENT_SCHEMA_ID).alias("value"))
    counted = counts.units_per_window(kafka.decode_avro(messages, EVENT_SCHEMA_ID), STATIONS)
    written = kafka.encode_avro(counted, COUNT_SCHEMA_ID)
    read = avro.decode(written, STATISTICS_AVRO_SCHEMA, COUNT_SCHEMA_ID)
    return counts.in_millis(read.withColumnsRenamed({"windowStart": "window_start", "windowEnd": "window_end"}))


@query(
    "generator_keys",
    f"WITH {STATION_EVENTS} SELECT event_id, ts, line, station, unit_id, action FROM station_events",
)
def generator_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.station_events(spark, sf_dir)
