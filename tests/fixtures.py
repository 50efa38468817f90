"""Literal test rows (no randomness)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

EVENT_ROW = StructType([
    StructField("event_duration", DoubleType(), True),
    StructField("device_type", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("location", StringType(), True),
    StructField("value", DoubleType(), True),
    StructField("unit", StringType(), True),
    StructField("battery_level", IntegerType(), True),
    StructField("signal_strength", IntegerType(), True),
    StructField("metadata", MapType(StringType(), StringType()), True),
    StructField("offset", LongType(), True),
])

KAFKA_ROW = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def event(duration=1.0, device_type="temperature_sensor", device_id="temperature_sensor_001",
          timestamp="2025-01-01 10:00:00", location="room_a", value=20.0, unit="celsius",
          battery=90, signal=-50, metadata=None, offset=0):
    t = ts(timestamp) if isinstance(timestamp, str) else timestamp
    return (duration, device_type, device_id, t, location, value, unit, battery, signal,
            metadata if metadata is not None else {"firmware": "1.0"}, offset)


def events_df(spark, rows):
    return spark.createDataFrame(rows, EVENT_ROW)


def kafka_df(spark, payloads, start=dt.datetime(2025, 1, 1)):
    rows = []
    for i, p in enumerate(payloads):
        text = p if isinstance(p, str) else json.dumps(p)
        rows.append((None, text.encode(), "iot-events", 0, i, start))
    return spark.createDataFrame(rows, KAFKA_ROW)
