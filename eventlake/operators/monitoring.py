"""Monitoring questions asked of the event data and of streaming progress:
message and byte rates per topic, consumer lag per partition, lag alerts,
failure rates per reason and error ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.numeric import safe_ratio
from eventlake.operators.joins import bounded_side, null_safe_join
from eventlake.operators.quality import REASONS, is_rejected, rules
from eventlake.schema import LAG_ALERT_LIMIT, RATE_WINDOW

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def window_seconds(size: str) -> int:
    """``"5 minutes"`` -> 300."""
    n, unit = size.split()
    return int(n) * _UNIT_SECONDS[unit.rstrip("s")]


def rate(df: DataFrame, by: Sequence[str] = ("topic",), value: str | None = None, size: str = RATE_WINDOW,
         time_col: str = "timestamp") -> DataFrame:
    """Per tumbling window and group: messages and messages/second; with
    ``value`` (a payload column) also bytes and bytes/second."""
    secs = float(window_seconds(size))
    measures = [F.count(F.lit(1)).alias("messages")]
    if value:
        measures.append(F.sum(F.octet_length(F.col(value))).alias("bytes"))
    agg = df.groupBy(F.window(time_col, size).alias("w"), *by).agg(*measures)
    cols = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
            "messages", (F.col("messages") / F.lit(secs)).alias("messages_per_sec")]
    if value:
        cols += ["bytes", (F.col("bytes") / F.lit(secs)).alias("bytes_per_sec")]
    return agg.select(*cols)


def lag_by_partition(records: DataFrame, as_of: str, time_col: str = "timestamp") -> DataFrame:
    """Consumer lag per (topic, partition) for a consumer that has read
    everything produced up to ``as_of``: latest offset, committed offset and
    the number of records not yet consumed."""
    seen = F.col(time_col) <= F.lit(as_of).cast("timestamp")
    return records.groupBy("topic", "partition").agg(
        F.max("offset").alias("latest_offset"),
        F.max(F.when(seen, F.col("offset"))).alias("committed_offset"),
        F.count_if(~seen).alias("lag"),
    )


def file_lag(records: DataFrame, processed: DataFrame, path_col: str = "path") -> DataFrame:
    """Lag per (topic, partition) of a query that reads files: ``records`` are the
    rows present with the ``path_col`` of their file, ``processed`` the paths
    the query has taken (``streaming.state.processed_files``). Latest offset,
    last offset read and the number of rows in files not yet taken."""
    taken, fits = bounded_side(processed.select(F.col("path").alias(path_col), F.lit(True).alias("_taken")),
                               name="processed_files")
    marked = null_safe_join(records, taken, [path_col], "left", fits)
    read = F.coalesce(F.col("_taken"), F.lit(False))
    return marked.groupBy("topic", "partition").agg(
        F.max("offset").alias("latest_offset"), F.max(F.when(read, F.col("offset"))).alias("committed_offset"),
        F.count_if(~read).alias("lag"))


def lag_alert(lag: DataFrame, limit: int = LAG_ALERT_LIMIT, by: Sequence[str] = ("topic",)) -> DataFrame:
    """Mean partition lag per group and whether it exceeds ``limit``."""
    return lag.groupBy(*by).agg(
        F.avg("lag").alias("mean_lag"), F.max("lag").alias("max_lag")
    ).withColumn("alert", F.col("mean_lag") > F.lit(limit))


def progress_lag(progress: DataFrame) -> DataFrame:
    """Lag per (query, source, topic, partition) from streaming progress rows
    (``StreamingQueryProgress.json`` text in column ``json``): the source's
    ``latestOffset`` minus the processed ``endOffset``."""
    offsets = "map<string,map<string,bigint>>"
    src = progress.select(
        F.get_json_object("json", "$.id").alias("query_id"),
        F.get_json_object("json", "$.batchId").cast("long").alias("batch_id"),
        F.explode(F.from_json(F.get_json_object("json", "$.sources"), "array<string>")).alias("source"),
    )
    src = src.select(
        "query_id", "batch_id",
        F.get_json_object("source", "$.description").alias("description"),
        F.from_json(F.get_json_object("source", "$.endOffset"), offsets).alias("end"),
        F.from_json(F.get_json_object("source", "$.latestOffset"), offsets).alias("latest"),
    )
    per_topic = src.select("query_id", "batch_id", "description", "latest",
                           F.explode("end").alias("topic", "end_parts"))
    per_part = per_topic.select("query_id", "batch_id", "description", "topic", "latest",
                                F.explode("end_parts").alias("partition", "end_offset"))
    latest = F.element_at(F.element_at(F.col("latest"), F.col("topic")), F.col("partition"))
    return per_part.select(
        "query_id", "batch_id", "description", "topic", F.col("partition").cast("int").alias("partition"),
        "end_offset", latest.alias("latest_offset"), (latest - F.col("end_offset")).alias("lag"))


def failure_rate(df: DataFrame, size: str = RATE_WINDOW, time_col: str | None = None,
                 mode: str = "lenient") -> DataFrame:
    """Rejected rows per window and reason, and per second. The windows are of
    the arrival time (``kafka_timestamp``, where the rows carry it): an event
    whose own time is missing or unreadable is a failure as well and must be
    counted. Rows without any time are counted under null windows. Rows
    carrying ``reject_reasons`` are exploded; otherwise one ``count_if`` per
    rule is taken per window and unpivoted (no per-row arrays)."""
    if time_col is None:
        time_col = "kafka_timestamp" if "kafka_timestamp" in df.columns else "timestamp"
    secs = window_seconds(size)
    # not window(): it drops rows without a time
    start = F.timestamp_micros(F.floor(F.unix_micros(time_col) / F.lit(secs * 1_000_000)).cast("bigint")
                               * F.lit(secs * 1_000_000)).alias("window_start")
    if REASONS in df.columns:
        exploded = df.filter(F.size(REASONS) > 0).select(F.col(time_col), F.explode(REASONS).alias("reason"))
        agg = exploded.groupBy(start, "reason").agg(F.count(F.lit(1)).alias("failures"))
    else:
        rl = rules(mode, None, columns=df.columns)
        wide = df.groupBy(start).agg(*[F.count_if(v).alias(name) for name, v in rl])
        agg = wide.unpivot(["window_start"], [name for name, _ in rl], "reason", "failures").filter(F.col("failures") > 0)
    return agg.select("window_start", (F.col("window_start") + F.expr(f"INTERVAL {secs} SECONDS")).alias("window_end"),
                      "reason", "failures", (F.col("failures") / F.lit(float(secs))).alias("failures_per_sec"))


def error_ratio(df: DataFrame, by: Sequence[str] = (), mode: str = "lenient") -> DataFrame:
    """Share of rejected rows per group; null for an empty group."""
    bad = F.count_if(is_rejected(df, mode))
    n = F.count(F.lit(1))
    return df.groupBy(*by).agg(bad.alias("errors"), n.alias("total"), safe_ratio(bad, n).alias("error_ratio"))
