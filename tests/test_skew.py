"""Hot keys: one device / one type-day / one group of copies holding a third
of all rows. Results must stay whole and exact, and every shuffle of event
rows must be preceded by a partial aggregate (map-side combine)."""

import datetime as dt
import re

from eventlake.operators import dedup, percentiles, quality, windows
from tests.fixtures import event, events_df


def _skewed_rows(n=600):
    base = dt.datetime(2025, 1, 1, 10, 0)
    out = []
    for i in range(n):
        hot = i % 3 == 0  # a third of the rows: one device in one minute
        t = base + (dt.timedelta(seconds=i % 50) if hot else dt.timedelta(seconds=7 * i))
        dev = "door_sensor_hot" if hot else f"door_sensor_{i % 40}"
        out.append(event(duration=1.0 + (i % 10) * 0.1, device_type="door_sensor", device_id=dev, timestamp=t,
                         value=float(i % 10), offset=i))
    return out


def _partial_before_every_exchange(plan: str) -> bool:
    """Each hash exchange sits directly on an aggregate (the map-side one:
    partial functions, or the key-only dedup of a distinct aggregate)."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning", line):
            nxt = lines[i + 1] if i + 1 < len(lines) else ""
            if not re.search(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(keys=", nxt):
                return False
    return True


def test_hot_device_window_exact_and_combined(spark):
    rows = _skewed_rows()
    df = events_df(spark, rows)
    agg = windows.minute_agg(df)
    hot = agg.filter("device_id = 'door_sensor_hot'").collect()
    assert sum(r.event_count for r in hot) == 200
    assert agg.agg({"event_count": "sum"}).first()[0] == 600
    plan = agg._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        static = windows.minute_agg(events_df(spark, rows))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert _partial_before_every_exchange(static), static
    assert "partial_" in plan or "AdaptiveSparkPlan" in plan


def test_hot_copies_dedup_exact(spark):
    # 200 redelivered copies of one event plus 400 distinct events
    copies = [event(timestamp="2025-01-01 09:00:00", device_id="door_sensor_x", offset=1000 + k) for k in range(200)]
    rows = _skewed_rows()[:400] + copies
    out = dedup.dedup(events_df(spark, rows))
    assert out.filter("device_id = 'door_sensor_x'").collect()[0].offset == 1000
    assert out.count() == len({(r[2], r[3]) for r in rows})


def test_hot_type_day_percentiles_whole(spark):
    rows = _skewed_rows()
    res = percentiles.percentile_report(events_df(spark, rows), min_events=10, sort=False).collect()
    assert len(res) == 1 and res[0].total_events == 600 and res[0].unique_devices == 41
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        q = percentiles.percentile_report(events_df(spark, rows), min_events=10, sort=False)
        plan = q._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # rows only cross the network pre-aggregated; the group stats are broadcast
    assert _partial_before_every_exchange(plan), plan
    assert "BroadcastHashJoin" in plan


def test_reason_counts_hot_reason(spark):
    rows = [event(battery=200, offset=i) for i in range(300)] + [event(offset=1000 + i) for i in range(600)]
    counts = quality.reason_counts(quality.apply_rules(events_df(spark, rows))).collect()
    assert [(r.reason, r.failures) for r in counts] == [("battery_out_of_range", 300)]
