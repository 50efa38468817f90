"""Registered queries: parsing and scalar functions, quality rules, window
aggregates, de-duplication and bounded reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.functions.parse import parse_iso, parse_kafka_json
from eventlake.functions.timeparts import hour_key, iso_text, with_time_parts
from eventlake.operators import dedup, quality, windows
from eventlake.plans.batch_queries import events
from eventlake.plans.registry import register
from eventlake.plans.sqlparts import EV, LENIENT_VALID, QEV
from eventlake.schema import DEVICE_TYPES
from eventlake.sources.adapters import kafka_records, read_events_table
from eventlake.sources.kafka import bounded_read

EVENT_FIELDS = ("event_duration", "device_type", "device_id", "timestamp", "location", "value", "unit",
                "battery_level", "signal_strength")


def records(spark, sf_dir, topic_col=None):
    return kafka_records(read_events_table(spark, sf_dir), topic_col)


def parsed(spark, sf_dir):
    return parse_kafka_json(records(spark, sf_dir))


# ---------------------------------------------------------------- parsing
PARSE_SQL = f"""
WITH {EV}
SELECT event_duration, device_type, device_id, "timestamp", location, value, unit, battery_level,
       signal_strength, json_extract_string(props, '$.k') AS metadata_k,
       device_id AS kafka_key, kafka_timestamp, "partition", "offset", CAST(NULL AS VARCHAR) AS _corrupt_record
FROM ev
"""


@register("parse_json", PARSE_SQL, ("event_duration", "value"))
def q_parse_json(spark, sf_dir):
    """Kafka records (JSON value) -> typed event columns, Kafka
    coordinates and the corrupt-record column."""
    p = parsed(spark, sf_dir)
    return p.select(*EVENT_FIELDS, F.col("metadata")["k"].alias("metadata_k"),
                    "kafka_key", "kafka_timestamp", "partition", "offset", "_corrupt_record")


TS_FORMS_SPARK = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
)
PARSE_TS_SQL = """
SELECT event_id,
       CASE event_id % 5
         WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
         WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
         WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
         WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         ELSE 'not a time ' || CAST(event_id AS VARCHAR) END AS ts_text,
       CASE event_id % 5
         WHEN 3 THEN date_trunc('second', ts)
         WHEN 4 THEN NULL
         ELSE ts END AS parsed
FROM events
"""


@register("parse_timestamp", PARSE_TS_SQL)
def q_parse_timestamp(spark, sf_dir):
    """ISO text in the forms producers send (offset, Z, naive, no
    fraction) and garbage -> TIMESTAMP or null, never an error."""
    src = read_events_table(spark, sf_dir)
    ts = F.col("ts").cast("timestamp")
    form = F.col("event_id") % 5
    text = F.when(form == 0, F.date_format(ts, TS_FORMS_SPARK[0]))
    for i in (1, 2, 3):
        text = text.when(form == i, F.date_format(ts, TS_FORMS_SPARK[i]))
    text = text.otherwise(F.concat(F.lit("not a time "), F.col("event_id").cast("string")))
    return src.select("event_id", text.alias("ts_text")).withColumn("parsed", parse_iso("ts_text"))


EVENT_DATE_SQL = f"""
WITH {EV}
SELECT "offset", "timestamp", CAST("timestamp" AS DATE) AS event_date FROM ev
"""


@register("event_date", EVENT_DATE_SQL)
def q_event_date(spark, sf_dir):
    """Timestamp -> UTC date."""
    return events(spark, sf_dir).select("offset", "timestamp", F.to_date("timestamp").alias("event_date"))


TIME_PARTS_SQL = f"""
WITH {EV}
SELECT "offset", CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
       CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour
FROM ev
"""


@register("time_parts", TIME_PARTS_SQL)
def q_time_parts(spark, sf_dir):
    """year/month/day/hour partition columns."""
    return with_time_parts(events(spark, sf_dir).select("offset", "timestamp"), "timestamp").drop("timestamp")


ISO_SQL = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso_timestamp FROM events
"""


@register("iso_format", ISO_SQL)
def q_iso_format(spark, sf_dir):
    """Timestamp -> ISO-8601 text with microseconds and offset."""
    src = read_events_table(spark, sf_dir)
    return src.select("event_id", iso_text(F.col("ts").cast("timestamp")).alias("iso_timestamp"))


HOUR_KEY_SQL = """
SELECT event_id, strftime(ts, '%Y/%m/%d/%H') AS hour_key, date_trunc('hour', ts) AS hour_start FROM events
"""


@register("hour_key", HOUR_KEY_SQL)
def q_hour_key(spark, sf_dir):
    """YYYY/MM/DD/HH folder key and hour start."""
    ts = F.col("ts").cast("timestamp")
    return read_events_table(spark, sf_dir).select(
        "event_id", hour_key(ts).alias("hour_key"), F.date_trunc("hour", ts).alias("hour_start"))


META_SQL = f"""
WITH {EV}
SELECT "offset", json_extract_string(props, '$.k') AS meta_k,
       array_to_string(list_sort(json_keys(props)), ',') AS meta_keys
FROM ev
"""


@register("metadata_lookup", META_SQL)
def q_metadata_lookup(spark, sf_dir):
    """Map access and sorted map keys of the metadata column."""
    return events(spark, sf_dir).select(
        "offset", F.col("metadata")["k"].alias("meta_k"),
        F.array_join(F.sort_array(F.map_keys("metadata")), ",").alias("meta_keys"))


# ---------------------------------------------------------------- quality
REQUIRED_SQL = f"""
WITH {EV}
SELECT "offset", device_id, "timestamp" FROM ev
WHERE event_duration IS NOT NULL AND device_type IS NOT NULL AND device_id IS NOT NULL
  AND "timestamp" IS NOT NULL AND value IS NOT NULL
"""


@register("dq_required", REQUIRED_SQL)
def q_dq_required(spark, sf_dir):
    """rows with all required fields present."""
    df = events(spark, sf_dir)
    req = [F.col(c).isNotNull() for c in quality.LENIENT_REQUIRED]
    cond = req[0]
    for c in req[1:]:
        cond = cond & c
    return df.filter(cond).select("offset", "device_id", "timestamp")


RANGES_SQL = f"""
WITH {EV}
SELECT "offset", device_id, "timestamp", event_duration, battery_level, signal_strength FROM ev
WHERE {LENIENT_VALID}
"""


@register("dq_ranges", RANGES_SQL, ("event_duration",))
def q_dq_ranges(spark, sf_dir):
    """lenient rules; valid rows only."""
    return quality.valid_rows(events(spark, sf_dir)).select(
        "offset", "device_id", "timestamp", "event_duration", "battery_level", "signal_strength")


STRICT_SQL = f"""
WITH {EV}
SELECT "offset", device_id, "timestamp", event_duration FROM ev
WHERE {LENIENT_VALID} AND event_duration >= 0.1 AND location IS NOT NULL AND unit IS NOT NULL
"""


@register("dq_strict", STRICT_SQL, ("event_duration",))
def q_dq_strict(spark, sf_dir):
    """strict rules (duration >= 0.1 s, location and unit required)."""
    return quality.valid_rows(events(spark, sf_dir), mode="strict").select(
        "offset", "device_id", "timestamp", "event_duration")


def _reason_sql(mode: str, with_types: bool) -> str:
    min_rule = "event_duration >= 0.1" if mode == "strict" else "event_duration > 0"
    req = ["event_duration", "device_type", "device_id", "timestamp", "value"]
    if mode == "strict":
        req += ["location", "unit"]
    parts = [f"""SELECT 'missing_{c}' AS reason, CAST(count_if("{c}" IS NULL) AS BIGINT) AS failures FROM ev""" for c in req]
    parts.append(f"""SELECT 'duration_out_of_range', CAST(count_if(COALESCE(NOT ({min_rule} AND event_duration <= 3600), FALSE)) AS BIGINT) FROM ev""")
    parts.append("""SELECT 'value_nan', CAST(count_if(COALESCE(isnan(value), FALSE)) AS BIGINT) FROM ev""")
    parts.append("""SELECT 'battery_out_of_range', CAST(count_if(COALESCE(NOT (battery_level BETWEEN 0 AND 100), FALSE)) AS BIGINT) FROM ev""")
    parts.append("""SELECT 'signal_out_of_range', CAST(count_if(COALESCE(NOT (signal_strength BETWEEN -120 AND -30), FALSE)) AS BIGINT) FROM ev""")
    if with_types:
        types = ", ".join(f"'{t}'" for t in DEVICE_TYPES)
        parts.append(f"""SELECT 'unknown_device_type', CAST(count_if(COALESCE(device_type NOT IN ({types}), FALSE)) AS BIGINT) FROM ev""")
    union = "\nUNION ALL ".join(parts)
    return f"WITH {EV},\nr AS ({union})\nSELECT reason, failures FROM r WHERE failures > 0"


@register("dq_device_type", _reason_sql("lenient", True))
def q_dq_device_type(spark, sf_dir):
    """allowed device types as an extra rule; failures per reason."""
    return quality.rule_failures(events(spark, sf_dir), device_types=DEVICE_TYPES)


@register("reject_reasons", _reason_sql("lenient", False))
def q_reject_reasons(spark, sf_dir):
    """F8/M7: rejected rows per reason (lenient rules)."""
    return quality.rule_failures(events(spark, sf_dir))


def _reasons_text_sql() -> str:
    """``reject_reasons`` joined with ',' in rule order (lenient rules)."""
    parts = [f"""CASE WHEN "{c}" IS NULL THEN 'missing_{c}' END"""
             for c in ("event_duration", "device_type", "device_id", "timestamp", "value")]
    parts += [
        "CASE WHEN COALESCE(NOT (event_duration > 0 AND event_duration <= 3600), FALSE) THEN 'duration_out_of_range' END",
        "CASE WHEN COALESCE(isnan(value), FALSE) THEN 'value_nan' END",
        "CASE WHEN COALESCE(NOT (battery_level BETWEEN 0 AND 100), FALSE) THEN 'battery_out_of_range' END",
        "CASE WHEN COALESCE(NOT (signal_strength BETWEEN -120 AND -30), FALSE) THEN 'signal_out_of_range' END",
    ]
    return "concat_ws(',', " + ", ".join(parts) + ")"


QUARANTINE_SQL = f"""
WITH {EV},
r AS (SELECT "offset", device_id, "timestamp", battery_level, signal_strength, {_reasons_text_sql()} AS reasons FROM ev)
SELECT * FROM r WHERE reasons <> ''
"""


@register("quarantine_rows", QUARANTINE_SQL)
def q_quarantine_rows(spark, sf_dir):
    """Every rejected row with the names of the rules it breaks."""
    bad = quality.quarantine(quality.apply_rules(events(spark, sf_dir)))
    return bad.select("offset", "device_id", "timestamp", "battery_level", "signal_strength",
                      F.array_join(quality.REASONS, ",").alias("reasons"))


FLAGS_SQL = f"""
WITH {EV},
{QEV}
SELECT "offset", battery_level, signal_strength, is_valid_battery, is_valid_signal FROM qev
"""


@register("dq_flags", FLAGS_SQL)
def q_dq_flags(spark, sf_dir):
    """battery and signal quality flags on valid rows."""
    return quality.quality_events(events(spark, sf_dir)).select(
        "offset", "battery_level", "signal_strength", "is_valid_battery", "is_valid_signal")


# ---------------------------------------------------------------- windows
def window_ctes(interval: str, source: str = "qev", extra: str = "") -> str:
    """CTE chain ending in ``agg``: the window aggregate of ``source`` rows
    (``extra`` CTEs are placed after ``qev``)."""
    extra = f"{extra},\n" if extra else ""
    return f"""{EV},
{QEV},
{extra}w AS (SELECT time_bucket(INTERVAL '{interval}', "timestamp") AS window_start, * FROM {source}),
agg AS (
SELECT window_start, window_start + INTERVAL '{interval}' AS window_end, device_id, device_type, location, unit,
       avg(value) AS avg_value, count(value) AS event_count, min(value) AS min_value, max(value) AS max_value,
       stddev_samp(value) AS stddev_value, avg(event_duration) AS avg_event_duration,
       avg(battery_level) AS avg_battery_level, avg(signal_strength) AS avg_signal_strength,
       CAST(count_if(NOT is_valid_battery) AS BIGINT) AS low_battery_count, CAST(count_if(NOT is_valid_signal) AS BIGINT) AS weak_signal_count,
       CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month,
       CAST(day(window_start) AS INTEGER) AS day, CAST(hour(window_start) AS INTEGER) AS hour
FROM w GROUP BY window_start, device_id, device_type, location, unit
)"""


def _window_sql(interval: str) -> str:
    return f"WITH {window_ctes(interval)}\nSELECT * FROM agg"


WINDOW_DOUBLES = ("avg_value", "min_value", "max_value", "stddev_value", "avg_event_duration",
                  "avg_battery_level", "avg_signal_strength")


@register("minute_window", _window_sql("1 minute"), WINDOW_DOUBLES)
def q_minute_window(spark, sf_dir):
    """1-minute device aggregate of valid events (batch)."""
    return windows.minute_agg(quality.quality_events(events(spark, sf_dir)))


@register("hour_window", _window_sql("1 hour"), WINDOW_DOUBLES)
def q_hour_window(spark, sf_dir):
    """A1 with a 1-hour window (groups large enough to exercise stddev)."""
    return windows.minute_agg(quality.quality_events(events(spark, sf_dir)), size="1 hour")


BY_DEVICE_SQL = f"""
WITH {EV},
{QEV},
w AS (SELECT time_bucket(INTERVAL '1 minute', "timestamp") AS window_start, * FROM qev)
SELECT window_start, window_start + INTERVAL '1 minute' AS window_end, device_id,
       arg_min(device_type, "offset") AS device_type,
       arg_min(location, "offset") AS location,
       arg_min(unit, "offset") AS unit,
       avg(value) AS avg_value, count(value) AS event_count, min(value) AS min_value, max(value) AS max_value,
       CASE WHEN count(value) = 1 THEN 0.0 ELSE stddev_samp(value) END AS stddev_value,
       avg(event_duration) AS avg_event_duration,
       avg(battery_level) AS avg_battery_level, avg(signal_strength) AS avg_signal_strength,
       CAST(count_if(NOT is_valid_battery) AS BIGINT) AS low_battery_count, CAST(count_if(NOT is_valid_signal) AS BIGINT) AS weak_signal_count,
       CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month,
       CAST(day(window_start) AS INTEGER) AS day, CAST(hour(window_start) AS INTEGER) AS hour
FROM w GROUP BY window_start, device_id
"""


@register("minute_window_by_device", BY_DEVICE_SQL, WINDOW_DOUBLES)
def q_minute_window_by_device(spark, sf_dir):
    """A2: (minute, device_id) aggregate; attributes of the first event; a
    one-event window has stddev 0.0."""
    return windows.minute_agg_by_device(quality.quality_events(events(spark, sf_dir)))


HOURLY_SQL = f"""
WITH {EV},
{QEV},
w AS (SELECT date_trunc('hour', "timestamp") AS window_start, * FROM qev)
SELECT window_start, window_start + INTERVAL '59 minutes 59 seconds' AS window_end, device_id,
       arg_min(device_type, "offset") AS device_type,
       arg_min(location, "offset") AS location,
       arg_min(unit, "offset") AS unit,
       avg(value) AS avg_value, count(value) AS event_count, min(value) AS min_value, max(value) AS max_value,
       avg(event_duration) AS avg_event_duration,
       avg(battery_level) AS avg_battery_level, avg(signal_strength) AS avg_signal_strength,
       CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month,
       CAST(day(window_start) AS INTEGER) AS day, CAST(hour(window_start) AS INTEGER) AS hour
FROM w GROUP BY window_start, device_id
"""


@register("hourly_agg", HOURLY_SQL, ("avg_value", "min_value", "max_value", "avg_event_duration",
                                     "avg_battery_level", "avg_signal_strength"))
def q_hourly_agg(spark, sf_dir):
    """A3: hourly device aggregate, window_end labelled HH:59:59."""
    return windows.hourly_agg(quality.quality_events(events(spark, sf_dir)))


@register("hourly_agg_no_offset", HOURLY_SQL.replace('"offset")', '("timestamp", "offset"))'), (
    "avg_value", "min_value", "max_value", "avg_event_duration", "avg_battery_level", "avg_signal_strength"))
def q_hourly_agg_no_offset(spark, sf_dir):
    """A3 on rows without offsets (the files source): the first event by time
    gives the attributes."""
    df = events(spark, sf_dir).withColumn("offset", F.lit(None).cast("long"))
    return windows.hourly_agg(quality.quality_events(df))


@register("minute_window_by_device_no_offset", BY_DEVICE_SQL.replace('"offset")', '("timestamp", "offset"))'),
          WINDOW_DOUBLES)
def q_minute_window_by_device_no_offset(spark, sf_dir):
    """A2 on rows without offsets (the files source)."""
    df = events(spark, sf_dir).withColumn("offset", F.lit(None).cast("long"))
    return windows.minute_agg_by_device(quality.quality_events(df))


HOUR_GROUPS_SQL = """
SELECT strftime(date_trunc('hour', ts), '%Y/%m/%d/%H') AS hour_key, date_trunc('hour', ts) AS hour_start,
       count(*) AS event_count
FROM events GROUP BY date_trunc('hour', ts)
"""


@register("hour_groups", HOUR_GROUPS_SQL)
def q_hour_groups(spark, sf_dir):
    """A4: events per clock hour."""
    return windows.hour_groups(events(spark, sf_dir))


# ---------------------------------------------------------------- dedup
DEDUP_BODY = """
SELECT device_id, "timestamp", arg_min("offset", "offset") AS "offset",
       arg_min(value, "offset") AS value
FROM ev GROUP BY device_id, "timestamp"
"""
DEDUP_SQL = f"WITH {EV}\n{DEDUP_BODY}"


@register("dedup_batch", DEDUP_SQL, ("value",))
def q_dedup_batch(spark, sf_dir):
    """W8 (batch): one row per (device_id, timestamp), first delivered copy."""
    df = events(spark, sf_dir).select("device_id", "timestamp", "offset", "value")
    return dedup.dedup(df)


# ---------------------------------------------------------------- bounded read
BOUNDED_N = 100
BOUNDED_SQL = f"""
WITH {EV}
SELECT "partition", "offset", kafka_timestamp AS "timestamp", device_id AS "key"
FROM ev ORDER BY "partition", "offset" LIMIT {BOUNDED_N}
"""


@register("bounded_read", BOUNDED_SQL)
def q_bounded_read(spark, sf_dir):
    """The first N records of the topic in (partition, offset) order
    (the limit is the feature: a bounded consumer test)."""
    r = bounded_read(records(spark, sf_dir), BOUNDED_N)
    return r.select("partition", "offset", "timestamp", F.col("key").cast("string").alias("key"))
