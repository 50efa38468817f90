"""Registered streaming queries. Each runs a Structured Streaming query over
the ``events`` file of the folder (file source, ``availableNow``) into a
Parquet file sink under the shared checkpoint folder, then returns the
committed output read back as a DataFrame."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators import dedup, windows
from eventlake.operators.quality import quality_events
from eventlake.plans.event_queries import (DEDUP_BODY, QUARANTINE_SQL, WINDOW_DOUBLES, _reasons_text_sql, records,
                                            window_ctes)
from eventlake.plans.registry import register
from eventlake.plans.sqlparts import EV, QEV
from eventlake.schema import EVENTS_TABLE_SCHEMA, TIME_PARTS, WATERMARK
from eventlake.session import shared_path
from eventlake.sources.adapters import device_events, read_events_table
from eventlake.sources.files import file_stream, path_exists
from eventlake.streaming.progress import attach, read_progress
from eventlake.streaming.sinks import state_partitions, stream_parquet
from eventlake.streaming.state import open_windows
from eventlake.streaming.stream_job import (StreamConfig, aggregate_output, quarantine_stream, raw_output,
                                            start_landed)


def event_stream(spark: SparkSession, folder: str, glob: str | None = "events.parquet",
                 max_files: int | None = None) -> DataFrame:
    return device_events(file_stream(spark, folder, EVENTS_TABLE_SCHEMA, glob=glob, max_files_per_trigger=max_files))


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


def drain(df: DataFrame, name: str, parts=None) -> tuple[str, str]:
    """Run ``df`` (a stream) to the end of the available input into a fresh
    Parquet folder; returns (output, checkpoint)."""
    spark = df.sparkSession
    out, ck = shared_path(spark, "streams", name, "out"), shared_path(spark, "streams", name, "ck")
    with state_partitions(spark):
        query = stream_parquet(df, out, ck, parts=parts, available_now=True)
    run_to_end(query)
    return out, ck


# ---------------------------------------------------------------- windows
STREAM_WINDOW_SQL = f"""
WITH {window_ctes('1 minute')}
SELECT * FROM agg
WHERE window_end <= (SELECT date_trunc('milliseconds', max("timestamp")) FROM qev) - INTERVAL '2 minutes'
"""


@register("minute_window_stream", STREAM_WINDOW_SQL, WINDOW_DOUBLES)
def q_minute_window_stream(spark, sf_dir):
    """A1+W1+W2: the 1-minute aggregate as a stream with a 2-minute
    watermark, append mode: windows are emitted once the watermark passes
    their end, so the last ~2 minutes stay open."""
    agg = windows.minute_agg(quality_events(event_stream(spark, sf_dir)), watermark=WATERMARK)
    out, _ = drain(agg, "minute_window", parts=())
    return spark.read.parquet(out)


OPEN_SQL = f"""
WITH {window_ctes('1 minute')}
SELECT *, window_end > (SELECT date_trunc('milliseconds', max("timestamp")) FROM qev) - INTERVAL '2 minutes' AS is_open
FROM agg
"""


@register("state_open_windows", OPEN_SQL, WINDOW_DOUBLES)
def q_open_windows(spark, sf_dir):
    """W2+W6: after the stream has read everything, the emitted windows plus
    those still in its state store are the batch aggregate."""
    agg = windows.minute_agg(quality_events(event_stream(spark, sf_dir)), watermark=WATERMARK)
    out, ck = drain(agg, "open_windows", parts=())
    emitted = spark.read.parquet(out).withColumn("is_open", F.lit(False))
    return emitted.unionByName(open_windows(spark, ck).withColumn("is_open", F.lit(True)))


LANDED_SQL = f"""
WITH {window_ctes('1 minute')},
closed AS (
  SELECT * FROM agg
  WHERE window_end <= (SELECT date_trunc('milliseconds', max("timestamp")) FROM qev) - INTERVAL '2 minutes'),
bad AS (SELECT * FROM (SELECT "offset", {_reasons_text_sql()} AS reasons FROM ev) WHERE reasons <> '')
SELECT 'raw' AS output, device_id AS item, count(*) AS n, CAST(sum("offset") AS BIGINT) AS total FROM qev GROUP BY 2
UNION ALL
SELECT 'aggregated', device_id, count(*), CAST(sum(event_count) AS BIGINT) FROM closed GROUP BY 2
UNION ALL
SELECT 'quarantine', reasons, count(*), CAST(sum("offset") AS BIGINT) FROM bad GROUP BY 2
"""


@register("one_read_outputs", LANDED_SQL)
def q_one_read_outputs(spark, sf_dir):
    """W7+K2+K3+F8: raw rows, closed windows and quarantine of the stream job
    with one read of the source (``start_landed``), summed per device or reasons."""
    topic = shared_path(spark, "streams", "one_read", "topic")
    recs = records(spark, sf_dir)
    recs.write.parquet(f"{topic}/batch=0")
    out = shared_path(spark, "streams", "one_read", "out")
    cfg = StreamConfig(out, shared_path(spark, "streams", "one_read", "ck"), available_now=True)
    for query in start_landed(spark, spark.readStream.schema(recs.schema).parquet(topic), cfg, land_first=True):
        run_to_end(query)

    def summed(name: str, item, total: str):
        return spark.read.parquet(f"{out}/{name}").groupBy(item.alias("item")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(total).alias("total")).select(F.lit(name).alias("output"), "item", "n", "total")

    return (summed("raw", F.col("device_id"), "offset")
            .unionByName(summed("aggregated", F.col("device_id"), "event_count"))
            .unionByName(summed("quarantine", F.array_join("reject_reasons", ","), "offset")))


RAW_SQL = f"""
WITH {EV},
{QEV}
SELECT "offset", device_id, "timestamp", event_duration, value, is_valid_battery, is_valid_signal,
       CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
       CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour
FROM qev
"""


@register("raw_partitioned", RAW_SQL, ("event_duration", "value"))
def q_raw_partitioned(spark, sf_dir):
    """K1+K2: valid, flagged events streamed to Parquet partitioned by
    year/month/day/hour and read back (partition values as INT)."""
    raw = raw_output(quality_events(event_stream(spark, sf_dir)))
    out, _ = drain(raw, "raw")
    return spark.read.parquet(out).select(
        "offset", "device_id", "timestamp", "event_duration", "value", "is_valid_battery", "is_valid_signal",
        "year", "month", "day", "hour")


# Arrival order of the replay: the first ten days, then the last ten, then
# the middle ten, which arrive after the watermark has passed them.
LATE_SPLITS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
LATE_ACC = f"""acc AS (SELECT * FROM qev WHERE "timestamp" < TIMESTAMP '{LATE_SPLITS[0]}'
                              OR "timestamp" >= TIMESTAMP '{LATE_SPLITS[1]}')"""
LATE_SQL = f"""
WITH {window_ctes('1 minute', source='acc', extra=LATE_ACC)}
SELECT * FROM agg
WHERE window_end <= (SELECT date_trunc('milliseconds', max("timestamp")) FROM acc) - INTERVAL '2 minutes'
"""


def replay_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    src = read_events_table(spark, sf_dir)
    lo, hi = (F.lit(s).cast("timestamp_ntz") for s in LATE_SPLITS)
    return [src.filter(F.col("ts") < lo), src.filter(F.col("ts") >= hi),
            src.filter((F.col("ts") >= lo) & (F.col("ts") < hi))]


@register("late_data_stream", LATE_SQL, WINDOW_DOUBLES)
def q_late_data_stream(spark, sf_dir):
    """W3+W6: the table replayed in three arrival batches into a folder the
    stream reads, restarting the query on the same checkpoint after each
    batch. The third batch is older than the watermark: its rows are dropped
    from the aggregates (they would stay in the raw output)."""
    inbox = shared_path(spark, "streams", "late", "inbox")
    out, ck = shared_path(spark, "streams", "late", "out"), shared_path(spark, "streams", "late", "ck")
    for i, batch in enumerate(replay_batches(spark, sf_dir)):
        batch.write.mode("overwrite").parquet(f"{inbox}/batch={i}")
        stream = device_events(file_stream(spark, inbox, EVENTS_TABLE_SCHEMA))
        agg = windows.minute_agg(quality_events(stream), watermark=WATERMARK)
        with state_partitions(spark):
            query = stream_parquet(agg, out, ck, parts=(), available_now=True)
        run_to_end(query)
    return spark.read.parquet(out)


@register("late_rows_in_raw", f"""
WITH {EV},
{QEV}
SELECT "offset", device_id, "timestamp", value FROM qev
""", ("value",))
def q_late_rows_in_raw(spark, sf_dir):
    """The same three arrival batches through the raw branch, which has no
    watermark: the late batch stays."""
    inbox = shared_path(spark, "streams", "late_raw", "inbox")
    out, ck = shared_path(spark, "streams", "late_raw", "out"), shared_path(spark, "streams", "late_raw", "ck")
    for i, batch in enumerate(replay_batches(spark, sf_dir)):
        batch.write.mode("overwrite").parquet(f"{inbox}/batch={i}")
        raw = raw_output(quality_events(device_events(file_stream(spark, inbox, EVENTS_TABLE_SCHEMA))))
        run_to_end(stream_parquet(raw, out, ck, parts=TIME_PARTS[:3], available_now=True))
    return spark.read.parquet(out).select("offset", "device_id", "timestamp", "value")


@register("agg_partitioned", f"""
WITH {window_ctes('1 hour')}
SELECT * FROM agg
WHERE window_end <= (SELECT date_trunc('milliseconds', max("timestamp")) FROM qev) - INTERVAL '2 minutes'
""", WINDOW_DOUBLES)
def q_agg_partitioned(spark, sf_dir):
    """K3+K5: the watermarked aggregate (hourly windows) in the sink's layout,
    partitioned by year/month/day/hour of the window, and read back."""
    agg = aggregate_output(quality_events(event_stream(spark, sf_dir)), window="1 hour")
    out, _ = drain(agg, "agg_partitioned", parts=TIME_PARTS)
    return spark.read.parquet(out).select(*agg.columns)


@register("stream_progress", "SELECT 'events' AS name, CAST(count(*) AS BIGINT) AS input_rows, TRUE AS counted FROM events")
def q_stream_progress(spark, sf_dir):
    """W9+M8: rows processed by a stream over the table, from its progress
    reports appended to a table in the shared folder."""
    table = shared_path(spark, "progress")
    collector = attach(spark)
    try:
        out, ck = shared_path(spark, "streams", "progress", "out"), shared_path(spark, "streams", "progress", "ck")
        query = stream_parquet(event_stream(spark, sf_dir).select("offset"), out, ck, parts=(), available_now=True,
                               query_name=f"events_{out.rpartition('/')[2]}")
        run_to_end(query)
        name = query.name
        for _ in range(100):  # reports come from the listener's own thread
            collector.flush(spark, table)
            if path_exists(spark, table) and read_progress(spark, table).filter(F.col("name") == name).filter(
                    "num_input_rows > 0").count():
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(collector)
    mine = read_progress(spark, table).filter(F.col("name") == name)
    return mine.agg(F.lit("events").alias("name"), F.sum("num_input_rows").alias("input_rows"),
                    (F.count("trigger_ms") > 0).alias("counted")).select("name", "input_rows", "counted")


# ---------------------------------------------------------------- dedup
DEDUP_STREAM_SQL = f"""
WITH {EV}
{DEDUP_BODY}
"""


@register("dedup_stream", DEDUP_STREAM_SQL, ("value",))
def q_dedup_stream(spark, sf_dir):
    """W8 (stream): one copy per (device_id, timestamp), emitted when it first
    arrives, so all unique events are out at the end of the input."""
    s = event_stream(spark, sf_dir).select("device_id", "timestamp", "offset", "value")
    out, _ = drain(dedup.dedup(s, watermark=WATERMARK), "dedup", parts=())
    return spark.read.parquet(out)


# ---------------------------------------------------------------- quarantine
@register("quarantine_stream", QUARANTINE_SQL)
def q_quarantine_stream(spark, sf_dir):
    """F8/K1 (stream): the table as Kafka records (JSON values) staged in a
    folder, decoded by the stream job's quarantine query and written
    partitioned by arrival hour; every rejected row keeps its reasons."""
    staged = shared_path(spark, "streams", "topic")
    recs = records(spark, sf_dir)
    recs.write.parquet(f"{staged}/batch=0")
    stream = spark.readStream.schema(recs.schema).parquet(staged)
    # bulk replay: unpartitioned output (the hourly layout of the quarantine
    # sink is covered by the stream-job test)
    out, _ = drain(quarantine_stream(stream), "quarantine", parts=())
    bad = spark.read.parquet(out)
    return bad.select("offset", "device_id", "timestamp", "battery_level", "signal_strength",
                      F.array_join("reject_reasons", ",").alias("reasons"))
