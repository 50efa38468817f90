"""Views of the generic ``events`` table in the device-event shape.

The test tables carry ``events(event_id, ts, user_id, event_type, value,
props)``. These adapters turn them into (a) raw-lake rows and (b) Kafka
records whose value is the event JSON, so every operator runs on data that
grows with the tables. Pure projections: they keep the scan's partitioning,
prune columns and push filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.timeparts import iso_text
from eventlake.schema import EVENTS_TABLE_SCHEMA
from eventlake.session import ensure_utc

# Fixed mapping used by the adapter (event_type -> unit of measurement).
UNIT_BY_TYPE = {
    "click": "clicks",
    "error": "errors",
    "purchase": "usd",
    "signup": "accounts",
    "view": "views",
}
DEFAULT_UNIT = "count"
KAFKA_PARTITIONS = 3  # partitions of the simulated topic
LOCATIONS = 10  # rooms a user's devices are spread over
TOPIC = "iot-events"


def _unit(event_type: Column) -> Column:
    expr = None
    for k, v in UNIT_BY_TYPE.items():
        expr = (F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v))
    return expr.otherwise(DEFAULT_UNIT)


def read_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.schema(EVENTS_TABLE_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def event_columns(src: DataFrame) -> list[Column]:
    """Event fields derived from an ``events`` row (timestamp as TIMESTAMP)."""
    k = F.from_json("props", "k INT")["k"]
    return [
        F.col("value").alias("event_duration"),
        F.col("event_type").alias("device_type"),
        F.concat_ws("_", F.col("event_type"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("room_"), (F.col("user_id") % LOCATIONS).cast("string")).alias("location"),
        F.col("value").alias("value"),
        _unit(F.col("event_type")).alias("unit"),
        k.alias("battery_level"),
        (F.lit(-30) - k).alias("signal_strength"),
        F.from_json("props", "map<string,string>").alias("metadata"),
    ]


def kafka_columns(src: DataFrame) -> list[Column]:
    return [
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
        (F.col("user_id") % KAFKA_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    ]


def device_events(src: DataFrame) -> DataFrame:
    """``events`` rows -> raw-lake rows (event fields + Kafka coordinates)."""
    return src.select(*event_columns(src), *kafka_columns(src))


def kafka_records(src: DataFrame, topic_col: str | None = None) -> DataFrame:
    """``events`` rows -> Kafka records (``key, value, topic, partition, offset,
    timestamp``); the value is the event as JSON with an ISO timestamp, like the
    producer writes it. ``topic_col`` names a column to use as topic."""
    ev = src.select(*event_columns(src), *kafka_columns(src), F.col("event_type"))
    payload = F.to_json(
        F.struct(
            "event_duration",
            "device_type",
            "device_id",
            iso_text("timestamp").alias("timestamp"),
            "location",
            "value",
            "unit",
            "battery_level",
            "signal_strength",
            "metadata",
        )
    )
    topic = F.col(topic_col) if topic_col else F.lit(TOPIC)
    return ev.select(
        F.col("device_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        topic.alias("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )
