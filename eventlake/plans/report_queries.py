"""Registered queries: reports, checks, monitoring, result round trips and
stage counts of the batch job."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventlake.functions.parse import parse_kafka_json
from eventlake.functions.timeparts import hour_key
from eventlake.operators import checks, monitoring, quality, reports
from eventlake.plans.batch_job import STAGES, BatchConfig, run_batch
from eventlake.plans.batch_queries import P95_CTES, P95_DOUBLES, P95_SQL, events, p95_result, raw_lake
from eventlake.plans.event_queries import parsed, records
from eventlake.plans.registry import register
from eventlake.plans.sqlparts import AS_OF, EV, LENIENT_VALID, MIN_EVENTS, ORACLE_MIN_EVENTS, r3
from eventlake.session import shared_path
from eventlake.sources.adapters import read_events_table
from eventlake.sources.files import file_stream, json_history, read_result
from eventlake.sources.writers import to_json_edge, write_history, write_result
from eventlake.streaming.sinks import stream_parquet
from eventlake.streaming.state import plain_path, processed_files

# ---------------------------------------------------------------- reports
SUMMARY_SQL = f"""
WITH {P95_CTES}
SELECT count(*) AS total_records, count(DISTINCT device_type) AS unique_device_types,
       count(DISTINCT event_date) AS unique_dates, avg(percentile_95th) AS avg_95th_percentile,
       quantile_disc(percentile_95th, 0.5) AS median_95th_percentile,
       quantile_disc(total_events, 0.5) AS median_events_per_day,
       CAST(sum(total_events) AS BIGINT) AS total_events_processed
FROM res
"""


@register("summary_stats", SUMMARY_SQL, ("avg_95th_percentile", "median_95th_percentile"))
def q_summary_stats(spark, sf_dir):
    """One-row summary of the percentile result."""
    return reports.summary_stats(p95_result(spark, sf_dir))


VALIDATION_SQL = f"""
WITH {P95_CTES}
SELECT 'total_records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM res
UNION ALL SELECT 'unique_device_types', CAST(count(DISTINCT device_type) AS VARCHAR) FROM res
UNION ALL SELECT 'unique_dates', CAST(count(DISTINCT event_date) AS VARCHAR) FROM res
UNION ALL SELECT 'avg_95th_percentile', CAST({r3('avg(percentile_95th)')} AS VARCHAR) FROM res
UNION ALL SELECT 'median_95th_percentile', CAST({r3('quantile_disc(percentile_95th, 0.5)')} AS VARCHAR) FROM res
UNION ALL SELECT 'median_events_per_day', CAST(quantile_disc(total_events, 0.5) AS VARCHAR) FROM res
UNION ALL SELECT 'total_events_processed', CAST(sum(total_events) AS VARCHAR) FROM res
UNION ALL SELECT 'computation_date', '{AS_OF.replace(' ', 'T')}.000000+00:00'
UNION ALL SELECT 'outlier_removal_method', '3_standard_deviations'
UNION ALL SELECT 'min_events_threshold', '{ORACLE_MIN_EVENTS}'
"""


@register("validation_report", VALIDATION_SQL)
def q_validation_report(spark, sf_dir):
    """A10: the (metric, value) report, built by unpivoting a one-row
    aggregate (nothing collected to the driver)."""
    return reports.validation_report(p95_result(spark, sf_dir), AS_OF, MIN_EVENTS)


STRICT_OK = f"""({LENIENT_VALID} AND event_duration >= 0.1 AND location IS NOT NULL AND unit IS NOT NULL)"""
CONFORMANCE_SQL = f"""
WITH {EV}
SELECT count(*) AS consumed, CAST(count_if({STRICT_OK}) AS BIGINT) AS valid, CAST(count_if(NOT {STRICT_OK}) AS BIGINT) AS invalid,
       CASE WHEN count(*) = 0 THEN NULL ELSE CAST(count_if({STRICT_OK}) AS BIGINT) * 100.0 / count(*) END AS success_pct
FROM ev
"""


@register("conformance_stats", CONFORMANCE_SQL, ("success_pct",))
def q_conformance_stats(spark, sf_dir):
    """consumed/valid/invalid/success % of the decoded topic under the
    strict rules."""
    return reports.conformance_stats(parsed(spark, sf_dir), mode="strict")


CONFORMANCE_VALUES_SQL = f"""
WITH {EV}
SELECT DISTINCT 'device_type' AS kind, device_type AS value FROM ev WHERE {STRICT_OK}
UNION ALL SELECT DISTINCT 'location', location FROM ev WHERE {STRICT_OK}
"""


@register("conformance_values", CONFORMANCE_VALUES_SQL)
def q_conformance_values(spark, sf_dir):
    """The sorted distinct types and locations of valid records, as long rows."""
    return reports.conformance_values(parsed(spark, sf_dir), mode="strict")


# ---------------------------------------------------------------- checks
def _s(expr: str) -> str:
    return f"COALESCE(CAST({expr} AS VARCHAR), 'null')"


RESULT_CHECKS_SQL = f"""
WITH {P95_CTES},
a AS (SELECT count(percentile_95th) AS n_p95, min(percentile_95th) AS min_p95, max(percentile_95th) AS max_p95,
             min(total_events) AS min_total, count(DISTINCT device_type) AS n_types FROM res),
c AS (
  SELECT 'expected_columns' AS "check", TRUE AS passed, 'all present' AS detail FROM a
  UNION ALL SELECT 'percentile_range', COALESCE(n_p95 > 0 AND min_p95 > 0 AND max_p95 < 1000, FALSE),
                   'min=' || {_s('min_p95')} || ' max=' || {_s('max_p95')} FROM a
  UNION ALL SELECT 'min_events_threshold', COALESCE(min_total >= {ORACLE_MIN_EVENTS}, FALSE),
                   'min=' || {_s('min_total')} FROM a
  UNION ALL SELECT 'multiple_device_types', COALESCE(n_types > 1, FALSE), 'types=' || {_s('n_types')} FROM a
  UNION ALL SELECT 'all_passed', COALESCE(n_p95 > 0 AND min_p95 > 0 AND max_p95 < 1000, FALSE)
                   AND COALESCE(min_total >= {ORACLE_MIN_EVENTS}, FALSE) AND COALESCE(n_types > 1, FALSE), '' FROM a
)
SELECT * FROM c
"""


@register("result_checks", RESULT_CHECKS_SQL)
def q_result_checks(spark, sf_dir):
    """Checks of the percentile result (columns, p95 range, threshold,
    several types)."""
    return checks.result_checks(p95_result(spark, sf_dir), min_events=MIN_EVENTS)


EVENT_CHECKS_SQL = f"""
WITH {EV},
a AS (SELECT count(DISTINCT device_type) AS n_types, count(DISTINCT location) AS n_locations,
             CAST(count_if(COALESCE(len(json_keys(props)), 0) <= 0) AS BIGINT) AS empty_metadata,
             CAST(count_if(NOT COALESCE(starts_with(device_id, device_type), FALSE)) AS BIGINT) AS bad_prefix,
             CAST(count_if(NOT COALESCE(event_duration > 0, FALSE)) AS BIGINT) AS bad_duration FROM ev)
SELECT 'multiple_device_types' AS "check", COALESCE(n_types > 1, FALSE) AS passed,
       'types=' || {_s('n_types')} AS detail FROM a
UNION ALL SELECT 'multiple_locations', COALESCE(n_locations > 1, FALSE), 'locations=' || {_s('n_locations')} FROM a
UNION ALL SELECT 'metadata_present', COALESCE(empty_metadata = 0, FALSE), 'empty=' || {_s('empty_metadata')} FROM a
UNION ALL SELECT 'device_id_prefix', COALESCE(bad_prefix = 0, FALSE), 'bad=' || {_s('bad_prefix')} FROM a
UNION ALL SELECT 'positive_duration', COALESCE(bad_duration = 0, FALSE), 'bad=' || {_s('bad_duration')} FROM a
"""


@register("event_checks", EVENT_CHECKS_SQL)
def q_event_checks(spark, sf_dir):
    """Checks of the event set (diversity, metadata, id prefix,
    positive durations)."""
    return checks.event_checks(events(spark, sf_dir))


FRESH_AS_OF = "2024-01-31 00:00:00"
FRESHNESS_SQL = f"""
WITH {EV},
a AS (SELECT max("timestamp") AS newest_event, count(*) AS events, CAST(count_if(NOT ({LENIENT_VALID})) AS BIGINT) AS rejected FROM ev),
b AS (SELECT newest_event, (epoch_us(TIMESTAMP '{FRESH_AS_OF}') - epoch_us(newest_event)) / 1000000.0 AS age_s,
             events, rejected, CASE WHEN events = 0 THEN NULL ELSE rejected * 1.0 / events END AS error_rate FROM a)
SELECT *, COALESCE(age_s <= 300, FALSE) AS fresh, COALESCE(error_rate <= 0.1, TRUE) AS error_ok,
       COALESCE(age_s <= 300, FALSE) AND COALESCE(error_rate <= 0.1, TRUE) AS healthy,
       '{FRESH_AS_OF.replace(' ', 'T')}.000000+00:00' AS as_of
FROM b
"""


@register("freshness_check", FRESHNESS_SQL, ("age_s", "error_rate"))
def q_freshness_check(spark, sf_dir):
    """Feed health as of a fixed instant (newest event age <= 300 s,
    rejected share <= 10 %)."""
    return checks.freshness_check(events(spark, sf_dir), FRESH_AS_OF)


# ---------------------------------------------------------------- monitoring
def topic_view(spark, sf_dir):
    """Events as messages of per-type topics: topic, partition, offset,
    timestamp, payload (the JSON props text)."""
    src = read_events_table(spark, sf_dir)
    return src.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("props").alias("payload"),
    )


RATE_SQL = """
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
       event_type AS topic, count(*) AS messages, count(*) / 300.0 AS messages_per_sec
FROM events GROUP BY 1, 2, 3
"""


@register("message_rate_5m", RATE_SQL, ("messages_per_sec",))
def q_message_rate(spark, sf_dir):
    """M1: messages per second per topic over 5-minute windows."""
    return monitoring.rate(topic_view(spark, sf_dir), by=("topic",))


BYTE_RATE_SQL = """
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
       event_type AS topic, count(*) AS messages, count(*) / 300.0 AS messages_per_sec,
       CAST(sum(octet_length(CAST(props AS BLOB))) AS BIGINT) AS bytes,
       sum(octet_length(CAST(props AS BLOB))) / 300.0 AS bytes_per_sec
FROM events GROUP BY 1, 2, 3
"""


@register("byte_rate_5m", BYTE_RATE_SQL, ("messages_per_sec", "bytes_per_sec"))
def q_byte_rate(spark, sf_dir):
    """M2: payload bytes per second per topic over 5-minute windows."""
    return monitoring.rate(topic_view(spark, sf_dir), by=("topic",), value="payload")


LAG_AS_OF = "2024-01-15 00:00:00"
LAG_SQL = f"""
SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", max(event_id) AS latest_offset,
       max(event_id) FILTER (WHERE ts <= TIMESTAMP '{LAG_AS_OF}') AS committed_offset,
       CAST(count_if(ts > TIMESTAMP '{LAG_AS_OF}') AS BIGINT) AS lag
FROM events GROUP BY 1, 2
"""


def running_lag(spark, sf_dir):
    """Lag of a stream over the topics' files: it has read what was there at an
    instant; the later messages have arrived since."""
    messages = topic_view(spark, sf_dir)
    inbox = shared_path(spark, "streams", "lag", "inbox")
    out, ck = shared_path(spark, "streams", "lag", "out"), shared_path(spark, "streams", "lag", "ck")
    early = F.col("timestamp") <= F.lit(LAG_AS_OF).cast("timestamp")
    messages.filter(early).write.parquet(f"{inbox}/arrival=0")
    query = stream_parquet(file_stream(spark, inbox, messages.schema).select("topic", "partition", "offset"), out, ck,
                           parts=(), available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    messages.filter(~early).write.parquet(f"{inbox}/arrival=1")
    present = spark.read.schema(messages.schema).parquet(inbox).select(
        "topic", "partition", "offset", plain_path(F.col("_metadata.file_path")).alias("path"))
    return monitoring.file_lag(present, processed_files(spark, ck))


@register("lag_by_partition", LAG_SQL)
def q_lag_by_partition(spark, sf_dir):
    """M3: lag of a running query per topic partition, from its checkpoint's
    log of processed files against the files present."""
    return running_lag(spark, sf_dir)


@register("unread_by_partition", LAG_SQL)
def q_unread_by_partition(spark, sf_dir):
    """M3 on stored records: latest offset, last offset up to an instant and
    the records after it, per topic partition."""
    return monitoring.lag_by_partition(topic_view(spark, sf_dir), LAG_AS_OF)


LAG_ALERT_SQL = f"""
WITH l AS ({LAG_SQL})
SELECT topic, avg(lag) AS mean_lag, max(lag) AS max_lag, avg(lag) > 1000 AS alert FROM l GROUP BY topic
"""


@register("lag_alert", LAG_ALERT_SQL, ("mean_lag",))
def q_lag_alert(spark, sf_dir):
    """M4: mean partition lag per topic and the > 1000 alert."""
    return monitoring.lag_alert(running_lag(spark, sf_dir))


FAILURE_SQL = f"""
WITH {EV},
f AS (
  SELECT kafka_timestamp, 'duration_out_of_range' AS reason FROM ev
    WHERE COALESCE(NOT (event_duration > 0 AND event_duration <= 3600), FALSE)
  UNION ALL SELECT kafka_timestamp, 'value_nan' FROM ev WHERE COALESCE(isnan(value), FALSE)
  UNION ALL SELECT kafka_timestamp, 'battery_out_of_range' FROM ev
    WHERE COALESCE(NOT (battery_level BETWEEN 0 AND 100), FALSE)
  UNION ALL SELECT kafka_timestamp, 'signal_out_of_range' FROM ev
    WHERE COALESCE(NOT (signal_strength BETWEEN -120 AND -30), FALSE)
)
SELECT time_bucket(INTERVAL '5 minutes', kafka_timestamp) AS window_start,
       time_bucket(INTERVAL '5 minutes', kafka_timestamp) + INTERVAL '5 minutes' AS window_end,
       reason, count(*) AS failures, count(*) / 300.0 AS failures_per_sec
FROM f GROUP BY 1, 2, 3
"""


@register("failure_rate_5m", FAILURE_SQL, ("failures_per_sec",))
def q_failure_rate(spark, sf_dir):
    """M5: rejected rows per reason per second over 5-minute windows of their arrival."""
    return monitoring.failure_rate(events(spark, sf_dir))


# events whose time is unreadable (every seventh) or whose JSON is broken (every eleventh)
BROKEN_SQL = f"""
WITH {EV},
b AS (SELECT *, "offset" % 11 = 0 AS broken, "offset" % 7 = 0 AND "offset" % 11 <> 0 AS no_time FROM ev),
f AS (
  SELECT 'malformed_json' AS reason FROM b WHERE broken
  UNION ALL SELECT 'missing_' || c FROM b, (VALUES ('event_duration'), ('device_type'), ('device_id'), ('timestamp'),
                                           ('value')) AS t(c) WHERE broken
  UNION ALL SELECT 'missing_timestamp' FROM b WHERE no_time
  UNION ALL SELECT 'duration_out_of_range' FROM b
    WHERE NOT broken AND COALESCE(NOT (event_duration > 0 AND event_duration <= 3600), FALSE)
  UNION ALL SELECT 'value_nan' FROM b WHERE NOT broken AND COALESCE(isnan(value), FALSE)
  UNION ALL SELECT 'battery_out_of_range' FROM b
    WHERE NOT broken AND COALESCE(NOT (battery_level BETWEEN 0 AND 100), FALSE)
  UNION ALL SELECT 'signal_out_of_range' FROM b
    WHERE NOT broken AND COALESCE(NOT (signal_strength BETWEEN -120 AND -30), FALSE)
)
SELECT reason, CAST(count(*) AS BIGINT) AS failures FROM f GROUP BY reason
"""


def broken_records(spark, sf_dir):
    """The topic with every eleventh value cut short and every seventh time unreadable."""
    text = F.col("value").cast("string")
    bad_time = F.regexp_replace(text, r'"timestamp":"[^"]*"', '"timestamp":"soon"')
    value = F.when(F.col("offset") % 11 == 0, F.lit("{cut")).when(F.col("offset") % 7 == 0, bad_time).otherwise(text)
    return records(spark, sf_dir).withColumn("value", value.cast("binary"))


@register("failures_of_broken_records", BROKEN_SQL)
def q_failures_of_broken_records(spark, sf_dir):
    """M5: failures per reason on a topic with broken JSON and unreadable
    times, summed over the arrival windows: none is lost."""
    rate = monitoring.failure_rate(parse_kafka_json(broken_records(spark, sf_dir)))
    return rate.groupBy("reason").agg(F.sum("failures").alias("failures"))


ERROR_RATIO_SQL = f"""
WITH {EV}
SELECT device_type, CAST(count_if(NOT ({LENIENT_VALID})) AS BIGINT) AS errors, count(*) AS total,
       CASE WHEN count(*) = 0 THEN NULL ELSE CAST(count_if(NOT ({LENIENT_VALID})) AS BIGINT) * 1.0 / count(*) END AS error_ratio
FROM ev GROUP BY device_type
"""


@register("error_ratio", ERROR_RATIO_SQL, ("error_ratio",))
def q_error_ratio(spark, sf_dir):
    """M6: share of rejected events per device type."""
    return monitoring.error_ratio(events(spark, sf_dir), by=("device_type",))


# ---------------------------------------------------------------- result files
def _roundtrip(spark, sf_dir, fmt):
    result = p95_result(spark, sf_dir)
    path = shared_path(spark, "results", fmt)
    write_result(result, path, fmt)
    return read_result(spark, path, fmt, schema=result.schema)


@register("roundtrip_parquet", P95_SQL, P95_DOUBLES)
def q_roundtrip_parquet(spark, sf_dir):
    """K6: result written as single-file snappy Parquet and read back."""
    return _roundtrip(spark, sf_dir, "parquet")


@register("roundtrip_csv", P95_SQL, P95_DOUBLES)
def q_roundtrip_csv(spark, sf_dir):
    """Result written as CSV with header and read back with its
    schema."""
    return _roundtrip(spark, sf_dir, "csv")


@register("roundtrip_json", P95_SQL, P95_DOUBLES)
def q_roundtrip_json(spark, sf_dir):
    """K6: result written as JSON lines and read back with its schema."""
    return _roundtrip(spark, sf_dir, "json")


# ---------------------------------------------------------------- JSON history
HISTORY_SQL = f"""
WITH {EV}
SELECT device_id, "timestamp", event_duration, value, location, unit, battery_level, signal_strength,
       json_extract_string(props, '$.k') AS metadata_k
FROM ev
"""


@register("history_roundtrip", HISTORY_SQL, ("event_duration", "value"))
def q_history_roundtrip(spark, sf_dir):
    """K8+S6: the events written as hourly JSON history folders
    (year/month/day/hour, ISO timestamps) and read back recursively."""
    path = shared_path(spark, "history")
    write_history(events(spark, sf_dir).drop("kafka_timestamp", "partition", "offset"), path)
    return _history_columns(json_history(spark, path, "lines"))


def _history_columns(h):
    return h.select("device_id", "timestamp", "event_duration", "value", "location", "unit", "battery_level",
                    "signal_strength", F.col("metadata")["k"].alias("metadata_k"))


@register("history_array", HISTORY_SQL, ("event_duration", "value"))
def q_history_array(spark, sf_dir):
    """The events as hourly files of one JSON array each (the upload
    format), read back with the layout decided per file. An hour has an array
    per task that reads some of it, so none outgrows a scan split."""
    path = shared_path(spark, "history_array")
    hourly = to_json_edge(events(spark, sf_dir).drop("kafka_timestamp", "partition", "offset")
                          .withColumn("hour_key", hour_key("timestamp")))
    record = F.to_json(F.struct(*[c for c in hourly.columns if c != "hour_key"])).alias("record")
    arrays = hourly.select("hour_key", record, F.spark_partition_id().alias("part")).groupBy("hour_key", "part").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("record"), ",\n "), F.lit("]")).alias("value"))
    (arrays.select("hour_key", "value").write.option("maxRecordsPerFile", 1)  # a file is one array
     .partitionBy("hour_key").text(path))
    return _history_columns(json_history(spark, path, "per_file"))


# ---------------------------------------------------------------- stage counts
STAGE_SQL = f"""
WITH {P95_CTES},
g AS (SELECT device_type, event_date FROM y GROUP BY device_type, event_date)
SELECT 'input_rows' AS stage, CAST((SELECT count(*) FROM events) AS BIGINT) AS "rows"
UNION ALL SELECT 'cleaned_rows', CAST((SELECT count(*) FROM x) AS BIGINT)
UNION ALL SELECT 'outliers', CAST((SELECT CAST(count_if(is_outlier) AS BIGINT) FROM fx) AS BIGINT)
UNION ALL SELECT 'rows_after_outliers', CAST((SELECT count(*) FROM y) AS BIGINT)
UNION ALL SELECT 'type_days', CAST((SELECT count(*) FROM g) AS BIGINT)
UNION ALL SELECT 'type_days_kept', CAST((SELECT count(*) FROM v) AS BIGINT)
UNION ALL SELECT 'result_rows', CAST((SELECT count(*) FROM res) AS BIGINT)
UNION ALL SELECT 'events_in_result', CAST((SELECT sum(total_events) FROM res) AS BIGINT)
"""


@register("stage_counts", STAGE_SQL)
def q_stage_counts(spark, sf_dir):
    """The batch job run on the raw lake, with row counts per stage
    gathered by observations during the job's own passes."""
    out = shared_path(spark, "batch")
    run = run_batch(spark, BatchConfig(raw_lake(spark, sf_dir), out, min_events=MIN_EVENTS, as_of=AS_OF))
    schema = StructType([StructField("stage", StringType(), False), StructField("rows", LongType(), False)])
    return spark.createDataFrame([(k, int(run.counts[k])) for k in STAGES], schema)
