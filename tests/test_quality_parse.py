"""Parsing and quality rules on literal rows (cases the upstream tests lack)."""

import math

from eventlake.functions.parse import parse_iso, parse_kafka_json
from eventlake.operators import quality
from tests.conftest import rows
from tests.fixtures import event, events_df, kafka_df

GOOD = {"event_duration": 1.5, "device_type": "door_sensor", "device_id": "door_sensor_1",
        "timestamp": "2025-01-01T10:00:00.123456+00:00", "location": "hall", "value": 1.0, "unit": "state",
        "metadata": {"open": True, "n": 3}}


def test_json_mixed(spark):
    bad_type = dict(GOOD, event_duration="bad")
    no_meta = dict(GOOD, metadata=None)
    df = quality.apply_rules(parse_kafka_json(kafka_df(spark, [GOOD, "{not json", bad_type, no_meta])))
    out = {r.offset: r for r in df.collect()}
    assert out[0].reject_reasons == [] and out[0].metadata == {"open": "true", "n": "3"}
    assert "malformed_json" in out[1].reject_reasons and out[1].event_duration is None
    assert out[2].reject_reasons == ["malformed_json", "missing_event_duration"]
    assert out[3].reject_reasons == [] and out[3].metadata is None


def test_int_fields_accept_integral_floats(spark):
    df = quality.apply_rules(parse_kafka_json(kafka_df(spark, [
        dict(GOOD, battery_level=50.0), dict(GOOD, signal_strength=-50.5), dict(GOOD, battery_level=3e9)])))
    out = {r.offset: r for r in df.collect()}
    assert out[0].battery_level == 50 and out[0].reject_reasons == []
    assert out[1].reject_reasons == ["malformed_json"]
    assert out[2].reject_reasons == ["malformed_json"]


def test_iso_forms(spark):
    texts = ["2025-01-01T10:11:13.123456", "2025-01-01T10:11:13.123456+00:00", "2025-01-01T10:11:13",
             "2025-01-01T10:11:00Z", "nope"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_iso("t").alias("p"))
    got = {r.t: (str(r.p) if r.p else None) for r in df.collect()}
    assert got == {
        "2025-01-01T10:11:13.123456": "2025-01-01 10:11:13.123456",
        "2025-01-01T10:11:13.123456+00:00": "2025-01-01 10:11:13.123456",
        "2025-01-01T10:11:13": "2025-01-01 10:11:13",
        "2025-01-01T10:11:00Z": "2025-01-01 10:11:00",
        "nope": None,
    }
    bad = quality.apply_rules(parse_kafka_json(kafka_df(spark, [dict(GOOD, timestamp="nope")]))).collect()[0]
    assert bad.reject_reasons == ["missing_timestamp"]


def test_nan_values_rejected(spark):
    df = quality.apply_rules(events_df(spark, [event(value=math.nan, offset=0), event(duration=math.nan, offset=1)]))
    out = {r.offset: r.reject_reasons for r in df.collect()}
    assert out == {0: ["value_nan"], 1: ["duration_out_of_range"]}


def test_range_edges(spark):
    durs = [0.0, 0.05, 0.1, 3600.0, 3600.01]
    df = events_df(spark, [event(d, offset=i) for i, d in enumerate(durs)]
                   + [event(battery=b, offset=10 + i) for i, b in enumerate((-1, 101))]
                   + [event(signal=s, offset=20 + i) for i, s in enumerate((-121, -29))])
    lenient = rows(quality.valid(quality.apply_rules(df)), "offset")
    strict = rows(quality.valid(quality.apply_rules(df, mode="strict")), "offset")
    assert lenient == [(1,), (2,), (3,)]
    assert strict == [(2,), (3,)]
    reasons = {r.offset: r.reject_reasons for r in quality.apply_rules(df).collect()}
    assert reasons[10] == ["battery_out_of_range"] and reasons[21] == ["signal_out_of_range"]


def test_flag_edges(spark):
    df = events_df(spark, [event(battery=b, signal=s, offset=i)
                           for i, (b, s) in enumerate([(19, -91), (20, -90), (None, None)])])
    out = rows(quality.with_flags(df), "offset", "is_valid_battery", "is_valid_signal")
    assert out == [(0, False, False), (1, True, True), (2, True, True)]


def test_reason_counts_and_quarantine(spark):
    df = quality.apply_rules(events_df(spark, [
        event(duration=None, offset=0), event(battery=-5, signal=-200, offset=1), event(offset=2)]))
    assert rows(quality.reason_counts(df)) == [("battery_out_of_range", 1), ("missing_event_duration", 1),
                                                ("signal_out_of_range", 1)]
    assert quality.quarantine(df).count() == 2 and quality.valid(df).count() == 1


def test_strict_requires_location_and_unit(spark):
    df = quality.apply_rules(events_df(spark, [event(location=None, unit=None)]), mode="strict")
    assert df.collect()[0].reject_reasons == ["missing_location", "missing_unit"]


def test_prepare_batch_cleaning(spark):
    df = events_df(spark, [event(0.0, offset=0), event(3600.0, offset=1), event(None, offset=2),
                           event(device_type=None, offset=3), event(timestamp=None, offset=4)])
    out = quality.prepare(df)
    assert rows(out, "offset") == [(1,)]
    assert "event_date" in out.columns


def test_rule_failures_equal_reason_counts(spark):
    from eventlake.operators import monitoring
    from eventlake.schema import DEVICE_TYPES

    df = events_df(spark, [event(duration=None, offset=0), event(battery=-5, signal=-200, offset=1),
                           event(value=math.nan, offset=2), event(device_type="x", offset=3), event(offset=4)])
    for kw in ({}, {"mode": "strict"}, {"device_types": DEVICE_TYPES}):
        assert rows(quality.rule_failures(df, **kw)) == rows(quality.reason_counts(quality.apply_rules(df, **kw)))
    cols = ("window_start", "reason", "failures")
    assert rows(monitoring.failure_rate(df), *cols) == rows(monitoring.failure_rate(quality.apply_rules(df)), *cols)
    assert rows(monitoring.error_ratio(df)) == rows(monitoring.error_ratio(quality.apply_rules(df)))
