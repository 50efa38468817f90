"""Streaming progress as data: a listener keeps the progress reports (JSON) of
every query until they are appended to a table in the shared folder, and ``progress_frame`` turns them into a DataFrame for
the monitoring queries (rates, batch durations, watermark drops, lag)."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType


class ProgressCollector(StreamingQueryListener):
    """Keeps every progress report (metadata, not data rows) until ``flush``."""

    def __init__(self):
        self._rows: list[str] = []
        self._lock = threading.Lock()
        self.errors: list[str] = []

    def onQueryStarted(self, event):  # noqa: N802 (Spark API names)
        pass

    def onQueryProgress(self, event):  # noqa: N802
        with self._lock:
            self._rows.append(event.progress.json)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        if event.exception:
            with self._lock:
                self.errors.append(str(event.exception))

    def reports(self) -> list[str]:
        with self._lock:
            return list(self._rows)


    def flush(self, spark: SparkSession, path: str) -> int:
        """Append the held reports to the table of JSON lines at ``path`` and
        let go of them; returns how many. Call it now and then from the code
        that runs the queries, so the history is durable and memory stays small."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(path)
        return len(rows)


def attach(spark: SparkSession) -> ProgressCollector:
    """Register a ``ProgressCollector`` on the session and return it."""
    collector = ProgressCollector()
    spark.streams.addListener(collector)
    return collector


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The reports of a table written by ``ProgressCollector.flush``."""
    return _measures(spark.read.text(path).select(F.col("value").alias("json")))


def progress_frame(spark: SparkSession, reports: list[str]) -> DataFrame:
    """Progress JSON -> one row per report with the usual measures."""
    schema = StructType([StructField("json", StringType(), False)])
    return _measures(spark.createDataFrame([(r,) for r in reports], schema))


def _measures(df: DataFrame) -> DataFrame:
    j = F.col("json")
    return df.select(
        F.get_json_object(j, "$.id").alias("query_id"),
        F.get_json_object(j, "$.name").alias("name"),
        F.get_json_object(j, "$.batchId").cast("long").alias("batch_id"),
        F.get_json_object(j, "$.numInputRows").cast("long").alias("num_input_rows"),
        F.get_json_object(j, "$.inputRowsPerSecond").cast("double").alias("input_rows_per_sec"),
        F.get_json_object(j, "$.processedRowsPerSecond").cast("double").alias("processed_rows_per_sec"),
        F.get_json_object(j, "$.durationMs.triggerExecution").cast("long").alias("trigger_ms"),
        F.get_json_object(j, "$.eventTime.watermark").alias("watermark"),
        F.aggregate(
            F.from_json(F.get_json_object(j, "$.stateOperators"), "array<struct<numRowsDroppedByWatermark:bigint>>"),
            F.lit(0).cast("long"),
            lambda acc, s: acc + F.coalesce(s["numRowsDroppedByWatermark"], F.lit(0).cast("long")),
        ).alias("rows_dropped_by_watermark"),
        j.alias("json"),
    )
