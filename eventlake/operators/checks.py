"""Checks on results and event sets. Each returns rows
``(check STRING, passed BOOLEAN, detail STRING)`` computed by one aggregate,
so a check over billions of events is one distributed pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.numeric import safe_ratio
from eventlake.functions.timeparts import iso_text
from eventlake.operators.quality import is_rejected
from eventlake.schema import FRESHNESS_MAX_AGE_S, FRESHNESS_MAX_ERROR, MIN_EVENTS

RESULT_COLUMNS = ("device_type", "event_date", "percentile_95th", "total_events", "unique_devices")
P95_RANGE = (0.0, 1000.0)  # exclusive bounds of a plausible p95 (seconds)


def _rows(one_row: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Turn a one-row aggregate into check rows with ``stack``."""
    parts = []
    for name, passed, detail in checks:
        parts += [F.lit(name), F.coalesce(passed, F.lit(False)), detail]
    stacked = F.inline(F.array(*[
        F.struct(parts[i].alias("check"), parts[i + 1].alias("passed"), parts[i + 2].cast("string").alias("detail"))
        for i in range(0, len(parts), 3)
    ]))
    return one_row.select(stacked)


def _s(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def result_checks(result: DataFrame, min_events: int = MIN_EVENTS,
                  expected_columns: Sequence[str] = RESULT_COLUMNS) -> DataFrame:
    """Checks of a percentile result: expected columns present; p95 present
    with ``0 < min`` and ``max < 1000``; every type-day has at least
    ``min_events`` events; more than one device type; and all of them."""
    missing = [c for c in expected_columns if c not in result.columns]
    cols_ok = F.lit(not missing)
    cols_detail = F.lit("missing: " + ",".join(missing) if missing else "all present")
    has = set(result.columns)
    p95 = F.col("percentile_95th") if "percentile_95th" in has else F.lit(None).cast("double")
    tot = F.col("total_events") if "total_events" in has else F.lit(None).cast("long")
    typ = F.col("device_type") if "device_type" in has else F.lit(None).cast("string")
    agg = result.agg(
        F.count(p95).alias("n_p95"),
        F.min(p95).alias("min_p95"),
        F.max(p95).alias("max_p95"),
        F.min(tot).alias("min_total"),
        F.count_distinct(typ).alias("n_types"),
    )
    p95_ok = (F.col("n_p95") > 0) & (F.col("min_p95") > P95_RANGE[0]) & (F.col("max_p95") < P95_RANGE[1])
    tot_ok = F.col("min_total") >= min_events
    typ_ok = F.col("n_types") > 1
    all_ok = cols_ok & F.coalesce(p95_ok, F.lit(False)) & F.coalesce(tot_ok, F.lit(False)) & typ_ok
    return _rows(agg, [
        ("expected_columns", cols_ok, cols_detail),
        ("percentile_range", p95_ok, F.concat(F.lit("min="), _s(F.col("min_p95")), F.lit(" max="), _s(F.col("max_p95")))),
        ("min_events_threshold", tot_ok, F.concat(F.lit("min="), _s(F.col("min_total")))),
        ("multiple_device_types", typ_ok, F.concat(F.lit("types="), _s(F.col("n_types")))),
        ("all_passed", all_ok, F.lit("")),
    ])


def event_checks(events: DataFrame) -> DataFrame:
    """Checks of an event set: more than one device type and location,
    metadata non-empty on every row, every device_id starts with its
    device_type, every duration positive."""
    agg = events.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("device_type").alias("n_types"),
        F.count_distinct("location").alias("n_locations"),
        F.count_if(F.coalesce(F.size("metadata"), F.lit(0)) <= 0).alias("empty_metadata"),
        F.count_if(~F.coalesce(F.col("device_id").startswith(F.col("device_type")), F.lit(False))).alias("bad_prefix"),
        F.count_if(~F.coalesce(F.col("event_duration") > 0, F.lit(False))).alias("bad_duration"),
    )
    return _rows(agg, [
        ("multiple_device_types", F.col("n_types") > 1, F.concat(F.lit("types="), _s(F.col("n_types")))),
        ("multiple_locations", F.col("n_locations") > 1, F.concat(F.lit("locations="), _s(F.col("n_locations")))),
        ("metadata_present", F.col("empty_metadata") == 0, F.concat(F.lit("empty="), _s(F.col("empty_metadata")))),
        ("device_id_prefix", F.col("bad_prefix") == 0, F.concat(F.lit("bad="), _s(F.col("bad_prefix")))),
        ("positive_duration", F.col("bad_duration") == 0, F.concat(F.lit("bad="), _s(F.col("bad_duration")))),
    ])


def freshness_check(checked: DataFrame, as_of: str, max_age_s: int = FRESHNESS_MAX_AGE_S,
                    max_error: float = FRESHNESS_MAX_ERROR, time_col: str = "timestamp") -> DataFrame:
    """Health of a feed as of ``as_of``: unhealthy when the newest event is
    older than ``max_age_s`` or the share of rejected rows exceeds
    ``max_error``. Rejected = ``reject_reasons`` non-empty when the rows carry
    it, else judged by the lenient rules."""
    now = F.lit(as_of).cast("timestamp")
    bad = is_rejected(checked)
    agg = checked.agg(
        F.max(F.col(time_col)).alias("newest_event"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(bad).alias("rejected"),
    )
    age = F.unix_micros(now) - F.unix_micros(F.col("newest_event"))
    out = agg.select(
        F.col("newest_event"),
        (age / F.lit(1_000_000.0)).alias("age_s"),
        F.col("events"),
        F.col("rejected"),
        safe_ratio(F.col("rejected"), F.col("events")).alias("error_rate"),
    )
    fresh = F.coalesce(F.col("age_s") <= max_age_s, F.lit(False))
    ok_err = F.coalesce(F.col("error_rate") <= max_error, F.lit(True))
    return out.withColumn("fresh", fresh).withColumn("error_ok", ok_err).withColumn(
        "healthy", fresh & ok_err).withColumn("as_of", iso_text(now))
