"""Streaming sinks. The file sink plus a checkpoint gives exactly-once output:
the sink's ``_spark_metadata`` log lists committed files, so readers never
see a half-written micro-batch and a restarted query neither duplicates nor
skips rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventlake.schema import TIME_PARTS, TRIGGER


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None) -> Iterator[int]:
    """Shuffle partitions for a stateful stream while it starts.

    Streaming has no AQE and the first checkpoint freezes the number of state
    partitions, so size it for the keys held in state (devices x open
    windows), by default the cluster's parallelism, instead of inheriting
    whatever the batch default is. The session value is restored after.
    """
    if not n:
        try:
            n = spark.sparkContext.defaultParallelism
        except Exception:  # Spark Connect: take the batch default
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = int(n)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def stream_parquet(df: DataFrame, path: str, checkpoint: str, trigger: str | None = TRIGGER,
                   parts: Sequence[str] | None = TIME_PARTS, available_now: bool = False,
                   query_name: str | None = None, output_mode: str = "append") -> StreamingQuery:
    """Append a stream to Parquet, Hive-partitioned by ``parts`` (when the
    columns exist), with its own checkpoint folder."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.outputMode(output_mode)
    if parts and all(p in df.columns for p in parts):
        w = w.partitionBy(*parts)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger, available_now).start()


def stream_memory(df: DataFrame, name: str, output_mode: str = "append", available_now: bool = True,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Memory sink (tests only: the rows live in the driver)."""
    w = df.writeStream.format("memory").queryName(name).outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, None, available_now).start()


def stop_gracefully(query: StreamingQuery, timeout_s: float = 10.0) -> bool:
    """Stop a query and wait at most ``timeout_s`` for it to end; True when
    it ended."""
    if query.isActive:
        query.stop()
    try:
        return bool(query.awaitTermination(timeout_s)) or not query.isActive
    except Exception:  # the query may already have failed; surface via .exception()
        return not query.isActive
