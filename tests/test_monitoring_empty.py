"""Monitoring queries and zero-row inputs."""

import json

import pytest

from eventlake.operators import checks, dedup, monitoring, outliers, percentiles, quality, reports, windows
from eventlake.streaming.progress import progress_frame
from tests.conftest import rows
from tests.fixtures import event, events_df

PROGRESS = {
    "id": "q1", "name": "raw_events", "batchId": 7, "numInputRows": 100, "inputRowsPerSecond": 10.0,
    "processedRowsPerSecond": 50.0, "durationMs": {"triggerExecution": 2000},
    "eventTime": {"watermark": "2025-01-01T10:00:00.000Z"},
    "stateOperators": [{"numRowsDroppedByWatermark": 3}, {"numRowsDroppedByWatermark": 2}],
    "sources": [{"description": "KafkaV2[Subscribe[iot-events]]",
                 "endOffset": {"iot-events": {"0": 100, "1": 250}},
                 "latestOffset": {"iot-events": {"0": 1300, "1": 260}}}],
}


def test_progress_lag_and_alert(spark):
    pf = progress_frame(spark, [json.dumps(PROGRESS)])
    r = pf.collect()[0]
    assert (r.batch_id, r.num_input_rows, r.trigger_ms, r.rows_dropped_by_watermark) == (7, 100, 2000, 5)
    lag = monitoring.progress_lag(pf)
    assert rows(lag, "topic", "partition", "lag") == [("iot-events", 0, 1200), ("iot-events", 1, 10)]
    alert = monitoring.lag_alert(lag).collect()[0]
    assert alert.mean_lag == 605.0 and alert.alert is False
    assert monitoring.lag_alert(lag, limit=500).collect()[0].alert is True


def test_rate_per_window(spark):
    df = spark.createDataFrame(
        [("t", "2025-01-01 10:00:01", "ab"), ("t", "2025-01-01 10:04:59", "abcd"), ("t", "2025-01-01 10:05:00", "")],
        "topic string, timestamp string, payload string").selectExpr("topic", "cast(timestamp as timestamp) timestamp",
                                                                     "payload")
    out = rows(monitoring.rate(df, value="payload"), "messages", "bytes", "bytes_per_sec")
    assert out == [(1, 0, 0.0), (2, 6, 6 / 300)]
    assert monitoring.window_seconds("1 hour") == 3600


def test_error_ratio_and_failure_rate(spark):
    df = quality.apply_rules(events_df(spark, [event(offset=0), event(battery=200, offset=1)]))
    r = monitoring.error_ratio(df).collect()[0]
    assert (r.errors, r.total, r.error_ratio) == (1, 2, 0.5)
    assert rows(monitoring.failure_rate(df), "reason", "failures") == [("battery_out_of_range", 1)]


def test_freshness(spark):
    df = quality.apply_rules(events_df(spark, [event(timestamp="2025-01-01 10:00:00")]))
    ok = checks.freshness_check(df, "2025-01-01 10:04:00").collect()[0]
    stale = checks.freshness_check(df, "2025-01-01 10:06:00").collect()[0]
    assert ok.healthy is True and ok.age_s == 240.0
    assert stale.healthy is False and stale.fresh is False


def test_event_checks(spark):
    df = events_df(spark, [event(device_type="a", device_id="a_1", location="x"),
                           event(device_type="b", device_id="zz", location="y", metadata={})])
    out = {r.check: r.passed for r in checks.event_checks(df).collect()}
    assert out == {"multiple_device_types": True, "multiple_locations": True, "metadata_present": False,
                   "device_id_prefix": False, "positive_duration": True}


def test_zero_rows_everywhere(spark):
    empty = events_df(spark, [])
    flagged = quality.apply_rules(empty)
    cleaned = quality.prepare(empty)
    for df in [quality.valid(flagged), quality.reason_counts(flagged), windows.minute_agg(empty),
               windows.minute_agg_by_device(empty), windows.hourly_agg(empty), windows.hour_groups(empty),
               outliers.remove_outliers(cleaned), percentiles.distinct_events(cleaned),
               percentiles.percentile_report(empty), dedup.dedup(empty), monitoring.error_ratio(flagged, ("device_type",))]:
        assert df.count() == 0
    st = reports.conformance_stats(flagged).collect()[0]
    assert (st.consumed, st.valid, st.success_pct) == (0, 0, None)
    assert reports.summary_stats(percentiles.percentile_report(empty)).collect()[0].total_records == 0
    fr = checks.freshness_check(flagged, "2025-01-01 00:00:00").collect()[0]
    assert fr.healthy is False and fr.error_rate is None


@pytest.mark.parametrize("stddev_mode,expected", [("null", None), ("zero", 0.0)])
def test_single_row_stddev(spark, stddev_mode, expected):
    df = events_df(spark, [event()])
    r = windows.minute_agg(df, single_row_stddev=stddev_mode).collect()[0]
    assert r.stddev_value == expected


def test_minute_by_device_first_attributes(spark):
    # arrival (offset) order decides, not event time
    df = events_df(spark, [event(location="first_room", value=1.0, timestamp="2025-01-01 10:00:30", offset=5),
                           event(location="late_room", timestamp="2025-01-01 10:00:10", offset=9)])
    r = windows.minute_agg_by_device(df).collect()[0]
    assert r.location == "first_room" and r.event_count == 2 and r.stddev_value > 0
    one = windows.minute_agg_by_device(events_df(spark, [event()])).collect()[0]
    assert one.stddev_value == 0.0
    # without Kafka coordinates, event time decides
    r2 = windows.minute_agg_by_device(df.drop("offset")).collect()[0]
    assert r2.location == "late_room"


def test_by_device_merges_rows_whose_attributes_change(spark):
    import statistics

    vals = [3.0, 9.5, 4.25, 12.0, 7.75, 1.5]
    locs = ["a", "b", "a", "c", "b", "a"]  # the device moves inside the minute
    evs = [event(value=v, location=loc, timestamp=f"2025-01-01 10:00:{10 + i:02d}", offset=100 - i)
           for i, (v, loc) in enumerate(zip(vals, locs))]
    r = windows.minute_agg_by_device(events_df(spark, evs)).collect()
    assert len(r) == 1
    r = r[0]
    assert r.event_count == 6 and r.location == "a"  # lowest offset = last row, location "a"
    assert r.avg_value == pytest.approx(statistics.fmean(vals))
    assert r.stddev_value == pytest.approx(statistics.stdev(vals), rel=1e-12)
    assert (r.min_value, r.max_value) == (1.5, 12.0)
