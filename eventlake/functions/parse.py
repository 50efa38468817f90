"""Kafka record decoding: binary value -> JSON struct -> typed event columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from eventlake.schema import EVENT_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def parse_iso(c: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP, null when unparseable (never throws).

    No pattern is given on purpose: the default parser accepts fractions of any
    length, no fraction, ``Z`` and ``+hh:mm`` offsets; text without an offset is
    read in the session zone (UTC in this library).
    """
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c)


def parse_kafka_json(df: DataFrame, schema: StructType = EVENT_SCHEMA, keep_corrupt: bool = True,
                     keep_payload: bool = False) -> DataFrame:
    """Kafka envelope -> one column per event field plus Kafka coordinates
    and the UTF-8 record key (``kafka_key``).

    Malformed JSON does not fail the query: its fields come out null and the
    raw text is kept in ``_corrupt_record`` so the quality rules can name the
    reason. Integer fields accept integral numbers written as floats (``50.0``
    -> 50); a fractional or out-of-range value (``50.5``, ``3e9``) marks the
    record malformed. With ``keep_payload`` the record's text (``raw_payload``)
    and the timestamp as written (``timestamp_text``) stay beside the fields.
    """
    int_fields = [f.name for f in schema.fields if isinstance(f.dataType, (IntegerType, LongType))]
    wide = [StructField(f.name, DoubleType(), True) if f.name in int_fields else f for f in schema.fields]
    parse_schema = StructType(wide + [StructField(CORRUPT_COLUMN, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    payload = F.col("value").cast("string")
    key = F.col("key").cast("string") if "key" in df.columns else F.lit(None).cast("string")
    # The parsed struct comes out of a generator (inline of a one-element
    # array): predicates on its fields cannot be pushed below it, so each
    # payload is parsed once. Selected directly, the optimizer would split
    # ``data.field`` accesses into one ``from_json`` per field and per filter.
    once = F.inline(F.array(F.struct(
        F.from_json(payload, parse_schema, options).alias("data"),
        payload.alias("_payload"),
        key.alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("partition"),
        F.col("offset").alias("offset"),
    )))
    out = df.select(once).select("data.*", "_payload", "kafka_key", "kafka_timestamp", "partition", "offset")
    # a number that is not a whole value of the field's type makes the record malformed
    limits = {"int": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1)}
    fractional = F.lit(False)
    for name in int_fields:
        d = F.col(name)
        lo, hi = limits[schema[name].dataType.simpleString()]
        fractional = fractional | F.coalesce((d != F.floor(d)) | (d < F.lit(float(lo))) | (d > F.lit(float(hi))),
                                             F.lit(False))
    out = out.withColumn(CORRUPT_COLUMN, F.when(fractional, F.coalesce(F.col(CORRUPT_COLUMN), F.col("_payload")))
                         .otherwise(F.col(CORRUPT_COLUMN)))
    out = out.withColumnRenamed("_payload", "raw_payload") if keep_payload else out.drop("_payload")
    for name in int_fields:
        d = F.col(name)
        out = out.withColumn(name, F.when(d == F.floor(d), d.try_cast(schema[name].dataType.simpleString())))
    if "timestamp" in schema.fieldNames() and isinstance(schema["timestamp"].dataType, StringType):
        if keep_payload:
            out = out.withColumn("timestamp_text", F.col("timestamp"))
        out = out.withColumn("timestamp", parse_iso("timestamp"))
    if not keep_corrupt:
        out = out.drop(CORRUPT_COLUMN)
    return out


def with_ingest_time(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Adds ``processing_timestamp``: the micro-batch time, or a fixed ``as_of``."""
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumn("processing_timestamp", ts)
