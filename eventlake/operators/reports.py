"""Summaries of a percentile result and of a consumed stream.

All of them are aggregates over DataFrames; no values travel through the
driver (the validation report is an unpivot of a one-row aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.numeric import round_half_up, safe_ratio
from eventlake.functions.timeparts import iso_text
from eventlake.operators.quality import is_rejected
from eventlake.schema import MIN_EVENTS, OUTLIER_METHOD


def summary_stats(result: DataFrame) -> DataFrame:
    """One row: result rows, distinct types and dates, mean and median p95,
    median events per type-day and total events."""
    return result.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("device_type").alias("unique_device_types"),
        F.count_distinct("event_date").alias("unique_dates"),
        F.avg("percentile_95th").alias("avg_95th_percentile"),
        F.percentile_approx("percentile_95th", 0.5).alias("median_95th_percentile"),
        F.percentile_approx("total_events", 0.5).alias("median_events_per_day"),
        F.sum("total_events").alias("total_events_processed"),
    )


REPORT_METRICS = (
    "total_records",
    "unique_device_types",
    "unique_dates",
    "avg_95th_percentile",
    "median_95th_percentile",
    "median_events_per_day",
    "total_events_processed",
    "computation_date",
    "outlier_removal_method",
    "min_events_threshold",
)


def validation_report(result: DataFrame, as_of: str | None = None, min_events: int = MIN_EVENTS,
                      method: str = OUTLIER_METHOD) -> DataFrame:
    """Long ``(metric STRING, value STRING)`` table: the summary measures
    (means and medians rounded to 3) plus run metadata. Null-safe on an empty
    result (measures come out null)."""
    s = summary_stats(result)
    when = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    wide = s.select(
        F.col("total_records").cast("string").alias("total_records"),
        F.col("unique_device_types").cast("string").alias("unique_device_types"),
        F.col("unique_dates").cast("string").alias("unique_dates"),
        round_half_up("avg_95th_percentile", 3).cast("string").alias("avg_95th_percentile"),
        round_half_up("median_95th_percentile", 3).cast("string").alias("median_95th_percentile"),
        F.col("median_events_per_day").cast("string").alias("median_events_per_day"),
        F.col("total_events_processed").cast("string").alias("total_events_processed"),
        iso_text(when).alias("computation_date"),
        F.lit(method).alias("outlier_removal_method"),
        F.lit(str(int(min_events))).alias("min_events_threshold"),
    )
    return wide.unpivot([], list(REPORT_METRICS), "metric", "value")


def conformance_stats(events: DataFrame, mode: str = "lenient") -> DataFrame:
    """Stream conformance: consumed, valid, invalid and success percentage.
    Rows without ``reject_reasons`` are judged by the rules' conjunction, so
    no per-row array is built."""
    ok = ~is_rejected(events, mode)
    return events.agg(
        F.count(F.lit(1)).alias("consumed"), F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"),
    ).withColumn("success_pct", safe_ratio(F.col("valid"), F.col("consumed"), 100.0))


def conformance_values(events: DataFrame, columns=("device_type", "location"), mode: str = "lenient") -> DataFrame:
    """The distinct values of ``columns`` among the valid rows, as sorted
    ``(kind, value)`` rows: the values come off the wire, so their number has
    no bound, and a distributed distinct and sort hold them."""
    good = events.filter(~is_rejected(events, mode)).select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = good.unpivot([], list(columns), "kind", "value").filter(F.col("value").isNotNull())
    return long.distinct().orderBy("kind", "value")
