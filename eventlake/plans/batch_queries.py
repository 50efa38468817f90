"""Registered batch queries: sources, cleaning, outliers and the percentile
query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import outliers, percentiles, quality
from eventlake.plans.registry import register
from eventlake.plans.sqlparts import AS_OF, CLEAN_Y, EV, MIN_EVENTS, ORACLE_MIN_EVENTS, r3
from eventlake.sources.adapters import device_events, read_events_table
from eventlake.sources.files import scan_events
from eventlake.sources.writers import compact_day, write_partitioned
from eventlake.session import shared_path


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_events(read_events_table(spark, sf_dir))


_LAKES: dict[tuple[str, str], str] = {}


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def raw_lake(spark: SparkSession, sf_dir: str) -> str:
    """The events table written once per application as the hourly
    partitioned raw lake (the layout the stream sink produces)."""
    key = (app_id(spark), sf_dir)
    if key not in _LAKES:
        path = shared_path(spark, "lake")
        write_partitioned(events(spark, sf_dir), path)
        _LAKES[key] = path
    return _LAKES[key]


# ---------------------------------------------------------------- flagship
# CTE chain of the flagship; ``res`` is the result table
P95_CTES = f"""{EV},
{CLEAN_Y},
v AS (
  SELECT device_type, event_date FROM y GROUP BY device_type, event_date
  HAVING count(DISTINCT (device_id, "timestamp")) >= {ORACLE_MIN_EVENTS}
),
res AS (
  SELECT device_type, event_date,
         {r3('quantile_disc(event_duration, 0.95)')} AS percentile_95th,
         {r3('quantile_disc(event_duration, 0.5)')} AS percentile_50th,
         {r3('quantile_disc(event_duration, 0.75)')} AS percentile_75th,
         {r3('quantile_disc(event_duration, 0.25)')} AS percentile_25th,
         {r3('avg(event_duration)')} AS mean_event_duration,
         {r3('stddev_samp(event_duration)')} AS stddev_event_duration,
         count(event_duration) AS total_events,
         count(DISTINCT device_id) AS unique_devices,
         TIMESTAMP '{AS_OF}' AS computation_timestamp,
         '3_standard_deviations' AS outlier_method,
         {ORACLE_MIN_EVENTS} AS min_events_threshold
  FROM y JOIN v USING (device_type, event_date)
  GROUP BY device_type, event_date
)"""
P95_SQL = f"WITH {P95_CTES}\nSELECT * FROM res"

P95_DOUBLES = ("percentile_95th", "percentile_50th", "percentile_75th", "percentile_25th",
               "mean_event_duration", "stddev_event_duration")


def p95_result(spark: SparkSession, sf_dir: str, min_events: int = MIN_EVENTS) -> DataFrame:
    return percentiles.percentile_report(events(spark, sf_dir), min_events=min_events, as_of=AS_OF)


@register("p95_by_type_day", P95_SQL, P95_DOUBLES)
def p95_by_type_day(spark, sf_dir):
    """A7 (flagship): p95/p50/p75/p25, mean, stddev, counts per type-day after
    cleaning, 3-sigma outlier removal and the distinct-event threshold."""
    return p95_result(spark, sf_dir)


BY_TYPE_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT device_type,
       {r3('quantile_disc(event_duration, 0.95)')} AS percentile_95th,
       {r3('quantile_disc(event_duration, 0.5)')} AS percentile_50th,
       {r3('quantile_disc(event_duration, 0.75)')} AS percentile_75th,
       {r3('quantile_disc(event_duration, 0.25)')} AS percentile_25th,
       {r3('avg(event_duration)')} AS mean_event_duration,
       {r3('stddev_samp(event_duration)')} AS stddev_event_duration,
       count(event_duration) AS total_events,
       count(DISTINCT device_id) AS unique_devices
FROM y GROUP BY device_type
"""


@register("p95_by_type", BY_TYPE_SQL, P95_DOUBLES)
def p95_by_type(spark, sf_dir):
    """A7 with large groups: exact percentiles per device type after the daily
    outlier removal. The sketch is kept small, so every group is refined by
    the bracket passes."""
    return percentiles.percentiles(_clean(spark, sf_dir), by=("device_type",), k=64, select_rows=100)


LOCATION = "nullif(concat('room_', right(device_id, 1)), 'room_3')"  # null for a tenth of the devices
BY_LOCATION_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT {LOCATION} AS location,
       {r3('quantile_disc(event_duration, 0.95)')} AS percentile_95th,
       {r3('quantile_disc(event_duration, 0.5)')} AS percentile_50th,
       {r3('quantile_disc(event_duration, 0.75)')} AS percentile_75th,
       {r3('quantile_disc(event_duration, 0.25)')} AS percentile_25th,
       {r3('avg(event_duration)')} AS mean_event_duration,
       {r3('stddev_samp(event_duration)')} AS stddev_event_duration,
       count(event_duration) AS total_events,
       count(DISTINCT device_id) AS unique_devices
FROM y GROUP BY ALL
"""


@register("p95_by_location", BY_LOCATION_SQL, P95_DOUBLES)
def p95_by_location(spark, sf_dir):
    """A7 by another key, one that is null in some rows: they are a group."""
    rows = _clean(spark, sf_dir).withColumn("location", F.expr(LOCATION))
    return percentiles.percentiles(rows, by=("location",))


# ---------------------------------------------------------------- sources
SCAN_SQL = f"""
WITH {EV}
SELECT device_type, device_id, "timestamp", event_duration FROM ev
"""


@register("scan_events", SCAN_SQL, ("event_duration",))
def q_scan_events(spark, sf_dir):
    """Scan of the raw lake with the job's column projection. The lake is
    written once from the events table (partitioned by year/month/day/hour)
    and scanned back."""
    return scan_events(spark, raw_lake(spark, sf_dir))


SCAN_DAY = "2024-01-15"
SCAN_DAY_SQL = f"""
WITH {EV}
SELECT device_type, device_id, "timestamp", event_duration FROM ev
WHERE CAST("timestamp" AS DATE) = DATE '{SCAN_DAY}'
"""


@register("scan_one_day", SCAN_DAY_SQL, ("event_duration",))
def q_scan_one_day(spark, sf_dir):
    """One day of the partitioned lake; the day predicate prunes the
    year/month/day folders and pushes a timestamp range into Parquet."""
    return scan_events(spark, raw_lake(spark, sf_dir), day=SCAN_DAY)


@register("compact_day", SCAN_DAY_SQL, ("event_duration",))
def q_compact_day(spark, sf_dir):
    """Small-file compaction: one day of the hourly lake rewritten round-robin
    into files of a target size (new path), then scanned like the lake."""
    out = shared_path(spark, "compacted")
    compact_day(spark, raw_lake(spark, sf_dir), SCAN_DAY, out)
    return scan_events(spark, out)


# ---------------------------------------------------------------- cleaning
PREPARE_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT device_type, device_id, "timestamp", event_duration, event_date FROM x
"""


@register("prepare_data", PREPARE_SQL, ("event_duration",))
def q_prepare(spark, sf_dir):
    """batch cleaning (event_date added; null and out-of-range rows out)."""
    return quality.prepare(events(spark, sf_dir).select("device_type", "device_id", "timestamp", "event_duration"))


# ---------------------------------------------------------------- outliers
BOUNDS_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT device_type, event_date, m AS daily_mean, sd AS daily_stddev, n AS daily_count,
       m - 3.0 * sd AS lower_bound, m + 3.0 * sd AS upper_bound
FROM st
"""


def _cleaned(spark, sf_dir):
    return quality.prepare(events(spark, sf_dir).select("device_type", "device_id", "timestamp", "event_duration"))


@register("daily_bounds", BOUNDS_SQL, ("daily_mean", "daily_stddev", "lower_bound", "upper_bound"))
def q_daily_bounds(spark, sf_dir):
    """O1: mean, sample stddev, count and 3-sigma bounds per type-day."""
    return outliers.daily_bounds(_cleaned(spark, sf_dir))


FLAG_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT device_type, event_date, device_id, "timestamp", event_duration, is_outlier FROM fx
"""


@register("outlier_flag", FLAG_SQL, ("event_duration",))
def q_outlier_flag(spark, sf_dir):
    """O2 + J1: every cleaned row with its is_outlier flag (rows joined with
    their group's bounds)."""
    df = _cleaned(spark, sf_dir)
    flagged = outliers.flag_outliers(df, outliers.daily_bounds(df))
    return flagged.select("device_type", "event_date", "device_id", "timestamp", "event_duration", "is_outlier")


REMOVED_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT device_type, event_date, device_id, "timestamp", event_duration FROM y
"""


@register("outliers_removed", REMOVED_SQL, ("event_duration",))
def q_outliers_removed(spark, sf_dir):
    """O3: rows within 3 standard deviations of their type-day mean."""
    return outliers.remove_outliers(_cleaned(spark, sf_dir)).select(
        "device_type", "event_date", "device_id", "timestamp", "event_duration")


RATE_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT CAST(count_if(is_outlier) AS BIGINT) AS outliers, count(*) AS total,
       CASE WHEN count(*) = 0 THEN NULL ELSE CAST(count_if(is_outlier) AS BIGINT) * 100.0 / count(*) END AS outlier_pct
FROM fx
"""


@register("outlier_rate", RATE_SQL, ("outlier_pct",))
def q_outlier_rate(spark, sf_dir):
    """Outliers / total * 100, null-safe."""
    df = _cleaned(spark, sf_dir)
    return outliers.outlier_rate(outliers.flag_outliers(df, outliers.daily_bounds(df)))


# ---------------------------------------------------------------- threshold
DISTINCT_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT device_type, event_date, count(DISTINCT (device_id, "timestamp")) AS distinct_events
FROM y GROUP BY device_type, event_date
"""


def _clean(spark, sf_dir):
    return outliers.remove_outliers(_cleaned(spark, sf_dir))


@register("distinct_events", DISTINCT_SQL)
def q_distinct_events(spark, sf_dir):
    """Distinct (device_id, timestamp) per type-day after outlier removal."""
    return percentiles.distinct_events(_clean(spark, sf_dir))


KEPT_SQL = f"""
WITH {EV},
{CLEAN_Y}
SELECT device_type, event_date, count(DISTINCT (device_id, "timestamp")) AS distinct_events
FROM y GROUP BY device_type, event_date
HAVING count(DISTINCT (device_id, "timestamp")) >= {ORACLE_MIN_EVENTS}
"""


@register("type_days_kept", KEPT_SQL)
def q_type_days_kept(spark, sf_dir):
    """type-days meeting the distinct-event threshold (HAVING)."""
    counts = percentiles.distinct_events(_clean(spark, sf_dir))
    return counts.filter(F.col("distinct_events") >= MIN_EVENTS)


MIN_FILTER_SQL = f"""
WITH {EV},
{CLEAN_Y},
v AS (
  SELECT device_type, event_date FROM y GROUP BY device_type, event_date
  HAVING count(DISTINCT (device_id, "timestamp")) >= {ORACLE_MIN_EVENTS}
)
SELECT y.device_type, y.event_date, y.device_id, y."timestamp", y.event_duration
FROM y WHERE (device_type, event_date) IN (SELECT (device_type, event_date) FROM v)
"""


@register("min_events_filter", MIN_FILTER_SQL, ("event_duration",))
def q_min_events_filter(spark, sf_dir):
    """Rows of kept type-days (left-semi join with the kept keys)."""
    return percentiles.keep_groups(_clean(spark, sf_dir), min_events=MIN_EVENTS).select(
        "device_type", "event_date", "device_id", "timestamp", "event_duration")


DIST_SQL = f"""
WITH {EV},
{CLEAN_Y},
c AS (SELECT device_type, event_date, count(DISTINCT (device_id, "timestamp")) AS distinct_events
      FROM y GROUP BY device_type, event_date)
SELECT avg(distinct_events) AS avg_events,
       quantile_disc(distinct_events, 0.5) AS median_events,
       quantile_disc(distinct_events, 0.95) AS p95_events
FROM c
"""


@register("event_count_distribution", DIST_SQL, ("avg_events",))
def q_event_count_distribution(spark, sf_dir):
    """Mean, median and p95 of distinct events per type-day."""
    return percentiles.group_size_distribution(percentiles.distinct_events(_clean(spark, sf_dir)))
