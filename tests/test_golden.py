"""Golden cases: exact values the upstream tests assert, as literal rows."""

import pytest

from eventlake.operators import checks, quality, windows
from tests.conftest import rows
from tests.fixtures import event, events_df


def test_hourly_one_device(spark):
    df = events_df(spark, [
        event(1.0, timestamp="2025-01-01 10:00:00", value=20.0, battery=90, signal=-50, offset=0),
        event(1.1, timestamp="2025-01-01 10:10:00", value=21.0, battery=89, signal=-51, offset=1),
        event(1.2, timestamp="2025-01-01 10:20:00", value=22.0, battery=88, signal=-52, offset=2),
    ])
    out = windows.hourly_agg(df).collect()
    assert len(out) == 1
    r = out[0]
    assert r.device_id == "temperature_sensor_001"
    assert r.event_count == 3
    assert r.avg_value == pytest.approx(21.0)
    assert r.min_value == 20.0 and r.max_value == 22.0
    assert r.avg_event_duration == pytest.approx(1.1, abs=1e-3)
    assert r.avg_battery_level == pytest.approx(89.0)
    assert r.avg_signal_strength == pytest.approx(-51.0)
    assert (r.year, r.month, r.day, r.hour) == (2025, 1, 1, 10)
    assert str(r.window_start) == "2025-01-01 10:00:00"
    assert str(r.window_end) == "2025-01-01 10:59:59"


def test_hourly_two_devices(spark):
    df = events_df(spark, [
        event(device_id="temperature_sensor_001", timestamp="2025-01-01 10:05:00"),
        event(device_id="temperature_sensor_002", timestamp="2025-01-01 10:15:00"),
    ])
    assert windows.hourly_agg(df).count() == 2


def test_hourly_null_status(spark):
    df = events_df(spark, [event(battery=None, signal=None), event(battery=None, signal=None,
                                                                  timestamp="2025-01-01 10:30:00")])
    r = windows.hourly_agg(df).collect()[0]
    assert r.avg_battery_level is None and r.avg_signal_strength is None


@pytest.mark.parametrize("times,expected", [
    (["2025-01-01 10:00:00", "2025-01-01 10:30:00", "2025-01-01 11:00:00", "2025-01-01 11:30:00",
      "2025-01-01 12:00:00", "2025-01-01 12:30:00"],
     [("2025/01/01/10", 2), ("2025/01/01/11", 2), ("2025/01/01/12", 2)]),
    (["2025-01-01 23:30:00", "2025-01-02 00:30:00"], [("2025/01/01/23", 1), ("2025/01/02/00", 1)]),
    ([], []),
])
def test_hour_groups(spark, times, expected):
    df = events_df(spark, [event(timestamp=t, offset=i) for i, t in enumerate(times)])
    assert rows(windows.hour_groups(df), "hour_key", "event_count") == expected


def _lenient(spark, ev, **kw):
    return quality.apply_rules(events_df(spark, [ev]), **kw).collect()[0]


def test_boundary_low_valid_flags_false(spark):
    df = quality.quality_events(events_df(spark, [event(0.1, battery=0, signal=-120)]))
    r = df.collect()
    assert len(r) == 1 and r[0].is_valid_battery is False and r[0].is_valid_signal is False


def test_boundary_high_valid_flags_true(spark):
    df = quality.quality_events(events_df(spark, [event(10.0, battery=100, signal=-30)]))
    r = df.collect()
    assert len(r) == 1 and r[0].is_valid_battery is True and r[0].is_valid_signal is True


def test_bad_device_type_rejected_only_by_type_rule(spark):
    from eventlake.schema import DEVICE_TYPES

    r = _lenient(spark, event(device_type="invalid_device_type"), device_types=DEVICE_TYPES)
    assert r.reject_reasons == ["unknown_device_type"]
    assert _lenient(spark, event(device_type="invalid_device_type")).reject_reasons == []


def test_missing_duration_rejected(spark):
    r = _lenient(spark, event(duration=None))
    assert r.reject_reasons == ["missing_event_duration"]


def test_checks_pass(spark):
    import datetime as dt

    res = spark.createDataFrame(
        [("temperature_sensor", dt.date(2025, 1, 1), 45.234, 1250, 10),
         ("humidity_sensor", dt.date(2025, 1, 1), 52.891, 1180, 12),
         ("pressure_sensor", dt.date(2025, 1, 1), 48.567, 1320, 9)],
        "device_type string, event_date date, percentile_95th double, total_events long, unique_devices long")
    out = {r.check: r.passed for r in checks.result_checks(res).collect()}
    assert out == {"expected_columns": True, "percentile_range": True, "min_events_threshold": True,
                   "multiple_device_types": True, "all_passed": True}


def test_result_checks_fail_on_missing_column_and_threshold(spark):
    import datetime as dt

    res = spark.createDataFrame([("a", dt.date(2025, 1, 1), 45.0, 10)],
                                "device_type string, event_date date, percentile_95th double, total_events long")
    out = {r.check: (r.passed, r.detail) for r in checks.result_checks(res).collect()}
    assert out["expected_columns"] == (False, "missing: unique_devices")
    assert out["min_events_threshold"] == (False, "min=10")
    assert out["multiple_device_types"][0] is False
    assert out["all_passed"][0] is False
