"""Shared SQL text for the oracle queries (run by DuckDB on the raw tables).

``EV`` is the SQL form of ``sources.adapters.device_events``.
"""

from eventlake.plans.registry import sql_round

MIN_EVENTS = 50  # distinct events a type-day needs in the registered queries, at every scale
ORACLE_MIN_EVENTS = MIN_EVENTS
AS_OF = "2024-02-01 00:00:00"

EV = """ev AS (
  SELECT value AS event_duration,
         event_type AS device_type,
         event_type || '_' || CAST(user_id AS VARCHAR) AS device_id,
         ts AS "timestamp",
         'room_' || CAST(user_id % 10 AS VARCHAR) AS location,
         value,
         CASE event_type WHEN 'click' THEN 'clicks' WHEN 'error' THEN 'errors' WHEN 'purchase' THEN 'usd'
                         WHEN 'signup' THEN 'accounts' WHEN 'view' THEN 'views' ELSE 'count' END AS unit,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS battery_level,
         -30 - TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS signal_strength,
         ts AS kafka_timestamp,
         CAST(user_id % 3 AS INTEGER) AS "partition",
         event_id AS "offset",
         event_type,
         props
  FROM events
)"""

# lenient rule set as SQL predicates on ``ev`` (a row is valid when all hold)
LENIENT_VALID = """event_duration IS NOT NULL AND device_type IS NOT NULL AND device_id IS NOT NULL
  AND "timestamp" IS NOT NULL AND value IS NOT NULL
  AND event_duration > 0 AND event_duration <= 3600 AND NOT isnan(value)
  AND (battery_level IS NULL OR battery_level BETWEEN 0 AND 100)
  AND (signal_strength IS NULL OR signal_strength BETWEEN -120 AND -30)"""

# quality events: valid rows with flags
QEV = f"""qev AS (
  SELECT *, COALESCE(battery_level >= 20 AND battery_level <= 100, TRUE) AS is_valid_battery,
            COALESCE(signal_strength >= -90, TRUE) AS is_valid_signal
  FROM ev WHERE {LENIENT_VALID}
)"""

# batch cleaning + 3-sigma outlier removal (rows kept in ``y``)
CLEAN_Y = """x AS (
  SELECT device_type, device_id, "timestamp", event_duration, CAST("timestamp" AS DATE) AS event_date
  FROM ev
  WHERE event_duration IS NOT NULL AND device_type IS NOT NULL AND "timestamp" IS NOT NULL
    AND event_duration > 0 AND event_duration <= 3600
),
st AS (
  SELECT device_type, event_date, avg(event_duration) AS m, stddev_samp(event_duration) AS sd,
         count(event_duration) AS n
  FROM x GROUP BY device_type, event_date
),
fx AS (
  SELECT x.*, st.m, st.sd, st.n,
         COALESCE(x.event_duration < st.m - 3.0 * st.sd OR x.event_duration > st.m + 3.0 * st.sd, FALSE) AS is_outlier
  FROM x JOIN st USING (device_type, event_date)
),
y AS (SELECT device_type, device_id, "timestamp", event_duration, event_date FROM fx WHERE NOT is_outlier)"""


def r3(expr: str) -> str:
    """SQL text of rounding to 3 decimals as printed (see ``registry.sql_round``)."""
    return sql_round(expr, 3)
