"""Schemas and fixed values of the device-event data model.

Every transform in the library takes and returns DataFrames whose columns are
named here, so the constants live in one place.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the upstream event contract, so they
# are written out literally and together.
# ---------------------------------------------------------------------------
DEVICE_TYPES = (
    "temperature_sensor",
    "humidity_sensor",
    "pressure_sensor",
    "motion_detector",
    "light_sensor",
    "smart_thermostat",
    "door_sensor",
    "window_sensor",
)
MAX_DURATION_S = 3600.0  # event_duration upper bound (inclusive)
STRICT_MIN_DURATION_S = 0.1  # strict mode lower bound (inclusive)
BATTERY_RANGE = (0, 100)  # battery_level accepted range
SIGNAL_RANGE = (-120, -30)  # signal_strength accepted range, dBm
LOW_BATTERY_BELOW = 20  # is_valid_battery = battery >= 20
WEAK_SIGNAL_BELOW = -90  # is_valid_signal = signal >= -90
OUTLIER_SIGMA = 3.0
OUTLIER_METHOD = "3_standard_deviations"
MIN_EVENTS = 500
PERCENTILE_PROBS = (0.95, 0.5, 0.75, 0.25)
WINDOW_SIZE = "1 minute"
WATERMARK = "2 minutes"
TRIGGER = "30 seconds"
FRESHNESS_MAX_AGE_S = 300
FRESHNESS_MAX_ERROR = 0.1
LAG_ALERT_LIMIT = 1000
RATE_WINDOW = "5 minutes"
TIME_PARTS = ("year", "month", "day", "hour")
DEFAULT_GROUP = ("device_type", "event_date")

# Wire form of one event (JSON value of a Kafka record). The timestamp stays a
# string here and is parsed by ``functions.parse.parse_iso``.
EVENT_SCHEMA = StructType(
    [
        StructField("event_duration", DoubleType(), True),
        StructField("device_type", StringType(), True),
        StructField("device_id", StringType(), True),
        StructField("timestamp", StringType(), True),
        StructField("location", StringType(), True),
        StructField("value", DoubleType(), True),
        StructField("unit", StringType(), True),
        StructField("battery_level", IntegerType(), True),
        StructField("signal_strength", IntegerType(), True),
        StructField("metadata", MapType(StringType(), StringType()), True),
    ]
)

# Kafka record envelope as the Spark Kafka source exposes it.
KAFKA_ENVELOPE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")

# One row of the raw lake: the parsed event with a real timestamp, its Kafka
# coordinates, ingest time and quality flags. Partition columns are added by
# the sink.
RAW_EVENT_SCHEMA = StructType(
    [
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
        StructField("kafka_timestamp", TimestampType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("processing_timestamp", TimestampType(), True),
        StructField("is_valid_battery", BooleanType(), True),
        StructField("is_valid_signal", BooleanType(), True),
    ]
)

# Columns the batch percentile job needs from the raw lake (column pruning).
PERCENTILE_INPUT_COLUMNS = ("device_type", "device_id", "timestamp", "event_duration")

# Layout of the driver-provided `events` test table.
EVENTS_TABLE_SCHEMA = StructType(
    [
        StructField("event_id", LongType(), True),
        StructField("ts", TimestampNTZType(), True),
        StructField("user_id", LongType(), True),
        StructField("event_type", StringType(), True),
        StructField("value", DoubleType(), True),
        StructField("props", StringType(), True),
    ]
)
