"""Kafka source wiring and bounded reads.

The Kafka connector jar is not part of a plain PySpark install; ``kafka_stream``
only builds the reader, so a missing connector surfaces when the query starts.
Everything downstream (``parse_kafka_json`` onwards) is tested on Kafka-shaped
rows built from the tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    group_id: str | None = None,
    options: Mapping[str, str] | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of the Spark Kafka source (plain text protocol, consumer group
    through ``kafka.group.id``). Offsets that have expired fail the query
    unless ``fail_on_data_loss`` is off."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
        "kafka.security.protocol": "PLAINTEXT",
    }
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets))
    if group_id:
        # the consumer-group option of the Spark Kafka source
        opts["kafka.group.id"] = group_id
    opts.update(dict(options or {}))
    return opts


def kafka_available(spark: SparkSession) -> bool:
    """Whether the Kafka connector is on the classpath (the data source
    resolves)."""
    try:
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", "localhost:0").option(
            "subscribe", "_probe").load()
        return True
    except Exception as e:  # noqa: BLE001
        msg = str(e).lower()
        return not ("data_source_not_found" in msg or "failed to find" in msg)


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    group_id: str | None = None,
    options: Mapping[str, str] | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Streaming Kafka source. Offsets are tracked in the query checkpoint
    (exactly-once with a file sink), not auto-committed."""
    return spark.readStream.format("kafka").options(
        **kafka_options(servers, topic, starting, max_offsets, group_id, options, fail_on_data_loss)
    ).load()


def kafka_batch(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    ending: str = "latest",
    options: Mapping[str, str] | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Bounded batch read of a topic between two offset specs."""
    opts = kafka_options(servers, topic, starting, options=options, fail_on_data_loss=fail_on_data_loss)
    opts["endingOffsets"] = ending
    return spark.read.format("kafka").options(**opts).load()


def bounded_read(df: DataFrame, n: int, order_by: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """The first ``n`` records in a deterministic order (a top-n, so Spark
    keeps only ``n`` rows per task before the single merge)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(int(n))
