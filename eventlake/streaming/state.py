"""What a streaming query has read and what it still holds, from its
checkpoint: windows that are open in the state store, and the files that the
file source has processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from eventlake.functions.timeparts import with_time_parts


def _average(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n)


def open_windows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The windows of ``minute_agg`` that are still in the state of the query
    with this checkpoint, finished as if they closed now: the columns of the
    aggregate. The query's last committed batch counts; it may be running.

    The buffers come in the order of the aggregate's columns: an average is
    (sum, count), a deviation (n, mean, squares)."""
    state = spark.read.format("statestore").option("operatorId", str(operator)).load(checkpoint)
    keys = state.schema["key"].dataType.names
    fields = state.schema["value"].dataType.fields
    # buffers share names; a cast of the struct renames them by position
    named = StructType([StructField(f"_b{i}", f.dataType) for i, f in enumerate(fields)])
    b = [F.col(f"_b{i}") for i in range(len(fields))]
    rows = state.select("key.*", F.col("value").cast(named).alias("_v")).select(*keys, "_v.*")
    out = rows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[k for k in keys if k != "window"],
        _average(b[0], b[1]).alias("avg_value"), b[2].alias("event_count"), b[3].alias("min_value"),
        b[4].alias("max_value"), F.when(b[5] > 1, F.sqrt(b[7] / (b[5] - 1))).alias("stddev_value"),
        _average(b[8], b[9]).alias("avg_event_duration"), _average(b[10], b[11]).alias("avg_battery_level"),
        _average(b[12], b[13]).alias("avg_signal_strength"), b[14].alias("low_battery_count"),
        b[15].alias("weak_signal_count"))
    return with_time_parts(out, "window_start")


def plain_path(path: Column) -> Column:
    """A file path in one spelling (``file:/a``, ``file:///a`` and encoded characters)."""
    return F.regexp_replace(F.try_url_decode(path), "^([a-z0-9]+):/+", "$1:/")


def processed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(path) of the files that the file source of the query with this
    checkpoint has taken, from its log (single batches and compacted ones)."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/sources/{source}")
    path = F.get_json_object("value", "$.path")
    return lines.filter(F.col("value").startswith("{")).select(plain_path(path).alias("path")).distinct()
