"""The streaming job: Kafka (or JSON-lines files) -> parse -> quality ->
raw lake, 1-minute aggregates and quarantine: three queries from one parsed
stream definition, each with its own checkpoint. The transforms are the batch
ones; only source and sink differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventlake.functions.parse import parse_kafka_json, with_ingest_time
from eventlake.functions.timeparts import with_time_parts
from eventlake.operators.quality import apply_rules, quality_events, quarantine, valid, with_flags
from eventlake.operators.windows import minute_agg
from eventlake.schema import TRIGGER, WATERMARK, WINDOW_SIZE
from eventlake.session import ensure_utc
from eventlake.sources.files import json_lines_records
from eventlake.sources.kafka import kafka_available, kafka_stream
from eventlake.streaming.sinks import state_partitions, stream_parquet


@dataclass
class StreamConfig:
    output_path: str
    checkpoint_path: str
    servers: str | None = None
    topic: str | None = None
    starting: str = "earliest"
    max_offsets: int | None = None
    group_id: str | None = None
    trigger: str | None = TRIGGER
    window: str = WINDOW_SIZE
    watermark: str = WATERMARK
    mode: str = "lenient"
    # state shuffle partitions are frozen by the first checkpoint; size them
    # for the key count (devices x open windows), not for the input volume
    state_partitions: int | None = None
    available_now: bool = False
    source: str = "kafka"  # kafka | files (JSON lines in ``input_path``)
    input_path: str | None = None


def quality_stream(records: DataFrame, mode: str = "lenient") -> DataFrame:
    """Kafka records -> valid, flagged events with ingest time."""
    return with_ingest_time(quality_events(parse_kafka_json(records, keep_corrupt=True), mode)).drop(
        "_corrupt_record", "kafka_key")


def quarantine_stream(records: DataFrame, mode: str = "lenient") -> DataFrame:
    """Kafka records -> rejected rows with ``reject_reasons``, the record's text
    (``raw_payload``) and its timestamp as written (``timestamp_text``), so
    that a rejected record can be repaired and replayed. Partitioned by Kafka
    arrival time: the event timestamp may be the broken field."""
    parsed = parse_kafka_json(records, keep_corrupt=True, keep_payload=True)
    rejected = quarantine(apply_rules(parsed, mode))
    return with_time_parts(with_ingest_time(rejected), "kafka_timestamp")


def raw_output(quality: DataFrame) -> DataFrame:
    """Raw lake rows: partition columns from the event timestamp. The raw
    branch has no watermark, so late rows are kept here."""
    return with_time_parts(quality, "timestamp")


def aggregate_output(quality: DataFrame, window: str = WINDOW_SIZE, watermark: str = WATERMARK) -> DataFrame:
    """Watermarked window aggregate of the quality stream (append mode)."""
    return minute_agg(quality, size=window, watermark=watermark)


def start_queries(spark: SparkSession, records: DataFrame,
                  cfg: StreamConfig) -> tuple[StreamingQuery, StreamingQuery, StreamingQuery]:
    """Raw lake, 1-minute aggregates and quarantine: three queries over one
    parsed stream definition, each with its own checkpoint (each reads the
    source on its own, as Structured Streaming queries do)."""
    ensure_utc(spark)
    q = quality_stream(records, cfg.mode)
    out, ck = cfg.output_path.rstrip("/"), cfg.checkpoint_path.rstrip("/")
    with state_partitions(spark, cfg.state_partitions):
        raw = stream_parquet(raw_output(q), f"{out}/raw", f"{ck}/raw", cfg.trigger,
                             available_now=cfg.available_now, query_name="raw_events")
        agg = stream_parquet(aggregate_output(q, cfg.window, cfg.watermark), f"{out}/aggregated",
                             f"{ck}/aggregated", cfg.trigger, available_now=cfg.available_now,
                             query_name="minute_aggregates")
        bad = stream_parquet(quarantine_stream(records, cfg.mode), f"{out}/quarantine", f"{ck}/quarantine",
                             cfg.trigger, available_now=cfg.available_now, query_name="quarantine")
    return raw, agg, bad


def landing(records: DataFrame, mode: str = "lenient") -> DataFrame:
    """Kafka records -> every record once: parsed, judged (``reject_reasons``) and
    with its payload, partitioned by the day it was landed."""
    judged = apply_rules(parse_kafka_json(records, keep_corrupt=True, keep_payload=True), mode)
    return with_ingest_time(judged).withColumn("landed_day", F.to_date(F.current_timestamp()))


def landed_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """The landed table as a stream; the sink's log tells which files are whole."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.parquet(path)


def start_landed(spark: SparkSession, records: DataFrame, cfg: StreamConfig,
                 land_first: bool = False) -> tuple[StreamingQuery, ...]:
    """Landing, raw lake, 1-minute aggregates and quarantine with one read and
    one parse of the source.

    One query reads the source and appends every parsed and judged record to
    ``<output>/landed``; the other three read that table. Its file sink and
    their file sources are exactly-once, so a restart on the same checkpoints
    neither loses nor repeats rows. The price is one more write of the records;
    a Kafka topic is read once instead of three times. ``land_first`` waits for
    the landing query to end (for ``available_now`` runs, whose readers take
    what is there when they start)."""
    ensure_utc(spark)
    out, ck = cfg.output_path.rstrip("/"), cfg.checkpoint_path.rstrip("/")
    rows = landing(records, cfg.mode)
    how = {"trigger": cfg.trigger, "available_now": cfg.available_now}
    land = stream_parquet(rows, f"{out}/landed", f"{ck}/landed", parts=("landed_day",), query_name="landed", **how)
    if land_first:
        land.awaitTermination()
    landed = landed_stream(spark, f"{out}/landed", rows.schema)
    good = with_flags(valid(landed)).drop("raw_payload", "timestamp_text", "_corrupt_record", "kafka_key", "landed_day")
    with state_partitions(spark, cfg.state_partitions):
        raw = stream_parquet(raw_output(good), f"{out}/raw", f"{ck}/raw", query_name="raw_events", **how)
        agg = stream_parquet(aggregate_output(good, cfg.window, cfg.watermark), f"{out}/aggregated",
                             f"{ck}/aggregated", query_name="minute_aggregates", **how)
        bad = stream_parquet(with_time_parts(quarantine(landed).drop("landed_day"), "kafka_timestamp"),
                             f"{out}/quarantine", f"{ck}/quarantine", query_name="quarantine", **how)
    return land, raw, agg, bad


def source_records(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Kafka records from the topic, or Kafka-shaped records from JSON-lines
    files."""
    if cfg.source == "files":
        if not cfg.input_path:
            raise ValueError("input_path is required for the files source")
        return json_lines_records(spark, cfg.input_path, cfg.max_offsets)
    if cfg.source != "kafka":
        raise ValueError("source must be 'kafka' or 'files'")
    if not (cfg.servers and cfg.topic):
        raise ValueError("servers and topic are required for the Kafka source")
    if not kafka_available(spark):
        raise RuntimeError("the Kafka connector (spark-sql-kafka) is not on the classpath; "
                           "add it with --packages or spark.jars")
    return kafka_stream(spark, cfg.servers, cfg.topic, cfg.starting, cfg.max_offsets, cfg.group_id)


def run_stream(spark: SparkSession, cfg: StreamConfig, timeout_s: float | None = None) -> None:
    """Start the queries and wait; the first failure of any query ends the
    wait (and is raised). With ``available_now`` the queries end at the end
    of the available input; a query that has not by ``timeout_s`` is an error
    (``TimeoutError``), as its output is incomplete."""
    records = source_records(spark, cfg)
    queries = start_queries(spark, records, cfg)
    late = []
    try:
        if cfg.available_now:
            for qq in queries:
                if timeout_s is None:
                    qq.awaitTermination()
                elif not qq.awaitTermination(timeout_s):
                    late.append(qq.name)
        elif timeout_s is None:
            spark.streams.awaitAnyTermination()
        else:
            spark.streams.awaitAnyTermination(timeout_s)
    finally:
        for qq in queries:
            if qq.isActive:
                qq.stop()
    for qq in queries:
        if qq.exception():
            raise RuntimeError(f"{qq.name} failed: {qq.exception()}")
    if late:
        raise TimeoutError(f"not at the end of the input after {timeout_s} s: {', '.join(late)}")
