"""eventlake: device-event analytics on Spark DataFrames, in batch and in
Structured Streaming.

The main entry points are re-exported here; every function takes and returns
DataFrames and never creates a session.
"""

from eventlake.functions.parse import parse_iso, parse_kafka_json
from eventlake.functions.timeparts import hour_key, iso_text, with_time_parts
from eventlake.operators.checks import event_checks, freshness_check, result_checks
from eventlake.operators.dedup import dedup
from eventlake.operators.monitoring import error_ratio, failure_rate, lag_alert, lag_by_partition, rate
from eventlake.operators.outliers import daily_bounds, flag_outliers, outlier_rate, remove_outliers
from eventlake.operators.percentiles import distinct_events, keep_groups, percentile_report, percentiles
from eventlake.operators.quality import (
    apply_rules,
    prepare,
    quality_events,
    quarantine,
    reason_counts,
    rule_failures,
    valid,
    valid_rows,
    with_flags,
)
from eventlake.operators.reports import conformance_stats, summary_stats, validation_report
from eventlake.operators.windows import hour_groups, hourly_agg, minute_agg, minute_agg_by_device
from eventlake.sources.files import json_history, read_result, scan_events
from eventlake.sources.kafka import bounded_read, kafka_stream
from eventlake.sources.writers import compact_day, write_history, write_partitioned, write_result

__version__ = "0.1.0"

__all__ = [
    "apply_rules", "bounded_read", "compact_day", "conformance_stats", "daily_bounds", "dedup", "distinct_events",
    "error_ratio", "event_checks", "failure_rate", "flag_outliers", "freshness_check", "hour_groups", "hour_key",
    "hourly_agg", "iso_text", "json_history", "kafka_stream", "keep_groups", "lag_alert", "lag_by_partition",
    "minute_agg", "minute_agg_by_device", "outlier_rate", "parse_iso", "parse_kafka_json", "percentile_report",
    "percentiles", "prepare", "quality_events", "quarantine", "rate", "read_result", "reason_counts",
    "remove_outliers", "result_checks", "rule_failures", "scan_events", "summary_stats", "valid", "valid_rows",
    "validation_report", "with_flags", "with_time_parts", "write_history", "write_partitioned", "write_result",
]
