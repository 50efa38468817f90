"""Data-quality rules with a reason for every rejected row.

Each rule is a (name, violation) pair; ``apply_rules`` evaluates all of them in
one projection and stores the names of the violated ones in
``reject_reasons`` (empty array = valid). Rows are never dropped silently:
``valid`` and ``quarantine`` split on the array and ``reason_counts`` explains
the split. Everything stays in one whole-stage-codegen projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.parse import CORRUPT_COLUMN
from eventlake.schema import (
    BATTERY_RANGE,
    LOW_BATTERY_BELOW,
    MAX_DURATION_S,
    SIGNAL_RANGE,
    STRICT_MIN_DURATION_S,
    WEAK_SIGNAL_BELOW,
)

REASONS = "reject_reasons"
LENIENT_REQUIRED = ("event_duration", "device_type", "device_id", "timestamp", "value")
STRICT_REQUIRED = LENIENT_REQUIRED + ("location", "unit")


def _between(c: Column, lo: float, hi: float) -> Column:
    return (c >= F.lit(lo)) & (c <= F.lit(hi))


def rule_checks(mode: str = "lenient", device_types: Sequence[str] | None = None,
                max_duration: float = MAX_DURATION_S, columns: Iterable[str] = ()) -> list[tuple[str, Column]]:
    """Ordered (reason, ok) pairs: ``ok`` is the positive form of each rule,
    written so that Parquet can take it (null tests, ranges). ``ok`` may be
    null only when a required field is null, which its own rule rejects.

    lenient: required fields, ``0 < event_duration <= max``, value not NaN,
    battery null or 0..100, signal null or -120..-30.
    strict: additionally ``event_duration >= 0.1`` and location/unit required.
    ``device_types``: reject types outside the list.
    """
    if mode not in ("lenient", "strict"):
        raise ValueError(f"mode must be 'lenient' or 'strict', got {mode!r}")
    out: list[tuple[str, Column]] = []
    if CORRUPT_COLUMN in set(columns):
        out.append(("malformed_json", F.col(CORRUPT_COLUMN).isNull()))
    required = STRICT_REQUIRED if mode == "strict" else LENIENT_REQUIRED
    out += [(f"missing_{c}", F.col(c).isNotNull()) for c in required]
    dur = F.col("event_duration")
    lo_ok = dur >= F.lit(STRICT_MIN_DURATION_S) if mode == "strict" else dur > F.lit(0.0)
    # NaN compares greater than any number, so it fails ``<= max``
    out.append(("duration_out_of_range", lo_ok & (dur <= F.lit(max_duration))))
    out.append(("value_nan", ~F.isnan("value")))
    battery, signal = F.col("battery_level"), F.col("signal_strength")
    out.append(("battery_out_of_range", battery.isNull() | _between(battery, *BATTERY_RANGE)))
    out.append(("signal_out_of_range", signal.isNull() | _between(signal, *SIGNAL_RANGE)))
    if device_types is not None:
        out.append(("unknown_device_type", F.col("device_type").isin(list(device_types))))
    return out


def rules(mode: str = "lenient", device_types: Sequence[str] | None = None,
          max_duration: float = MAX_DURATION_S, columns: Iterable[str] = ()) -> list[tuple[str, Column]]:
    """Ordered (reason, violation) pairs; a violation is a non-null boolean
    (a rule whose input is null is not violated: the missing-field rule
    names that row)."""
    return [(name, F.coalesce(~ok, F.lit(False)))
            for name, ok in rule_checks(mode, device_types, max_duration, columns)]


def reasons_column(rule_list: Sequence[tuple[str, Column]]) -> Column:
    """Array of the names of the violated rules (rule order, no nulls)."""
    return F.array_compact(F.array(*[F.when(v, F.lit(name)) for name, v in rule_list]))


def valid_predicate(checks: Sequence[tuple[str, Column]]) -> Column:
    """All rules hold: a plain conjunction for the valid-row path (no
    per-row array), pushed to the scan where the source allows."""
    pred = F.lit(True)
    for _, ok in checks:
        pred = pred & ok
    return pred


def apply_rules(df: DataFrame, mode: str = "lenient", device_types: Sequence[str] | None = None,
                max_duration: float = MAX_DURATION_S) -> DataFrame:
    """Adds ``reject_reasons``: names of the violated rules, in rule order."""
    return df.withColumn(REASONS, reasons_column(rules(mode, device_types, max_duration, df.columns)))


def with_flags(df: DataFrame, min_battery: int = LOW_BATTERY_BELOW, min_signal: int = WEAK_SIGNAL_BELOW) -> DataFrame:
    """Quality flags (not filters): a missing reading counts as valid."""
    return df.withColumn(
        "is_valid_battery",
        F.coalesce((F.col("battery_level") >= min_battery) & (F.col("battery_level") <= BATTERY_RANGE[1]), F.lit(True)),
    ).withColumn("is_valid_signal", F.coalesce(F.col("signal_strength") >= min_signal, F.lit(True)))


def valid(df: DataFrame) -> DataFrame:
    """Rows of ``apply_rules`` output without reasons (the column is dropped)."""
    return df.filter(F.size(REASONS) == 0).drop(REASONS)


def quarantine(df: DataFrame) -> DataFrame:
    """Rows of ``apply_rules`` output with at least one reason."""
    return df.filter(F.size(REASONS) > 0)


def reason_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rejected rows per reason (a row with two reasons counts under both).

    Map-side partial counts, so a hot reason costs one row per task."""
    return (
        df.filter(F.size(REASONS) > 0)
        .select(*by, F.explode(REASONS).alias("reason"))
        .groupBy(*by, "reason")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def rule_failures(df: DataFrame, by: Sequence[str] = (), mode: str = "lenient",
                  device_types: Sequence[str] | None = None, max_duration: float = MAX_DURATION_S) -> DataFrame:
    """Failures per rule (and group), straight from the rules: one
    ``count_if`` per rule in one aggregate, then unpivoted to
    ``(reason, failures)``; only reasons with failures are kept. Same numbers
    as ``reason_counts(apply_rules(df))`` without a per-row array or explode.
    """
    rl = rules(mode, device_types, max_duration, df.columns)
    names = [name for name, _ in rl]
    wide = df.groupBy(*by).agg(*[F.count_if(v).alias(name) for name, v in rl])
    return (wide.unpivot(list(by), names, "reason", "failures")
            .filter(F.col("failures") > 0))


def is_rejected(df: DataFrame, mode: str = "lenient", device_types: Sequence[str] | None = None) -> Column:
    """Row-level rejected flag: from ``reject_reasons`` when present, else
    from the rules directly."""
    if REASONS in df.columns:
        return F.size(REASONS) > 0
    return ~F.coalesce(valid_predicate(rule_checks(mode, device_types, MAX_DURATION_S, df.columns)), F.lit(False))


def valid_rows(df: DataFrame, mode: str = "lenient", device_types: Sequence[str] | None = None,
               max_duration: float = MAX_DURATION_S) -> DataFrame:
    """Rows passing every rule (same rules as ``apply_rules``), as one filter
    predicate that Parquet can partly take (null checks, ranges)."""
    return df.filter(valid_predicate(rule_checks(mode, device_types, max_duration, df.columns)))


def quality_events(df: DataFrame, mode: str = "lenient", device_types: Sequence[str] | None = None) -> DataFrame:
    """The streaming job's quality stage: valid rows with flags."""
    return with_flags(valid_rows(df, mode, device_types))


def prepare(df: DataFrame, max_duration: float = MAX_DURATION_S, time_col: str = "timestamp") -> DataFrame:
    """Batch cleaning for the percentile job: adds ``event_date`` and keeps
    rows with duration, type and date present and ``0 < duration <= max``."""
    return df.withColumn("event_date", F.to_date(F.col(time_col))).filter(
        F.col("event_duration").isNotNull()
        & F.col("device_type").isNotNull()
        & F.col("event_date").isNotNull()
        & (F.col("event_duration") > 0)
        & (F.col("event_duration") <= max_duration)
    )
