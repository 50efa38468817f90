"""Outliers, distinct-event threshold and the percentile result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlake.operators import outliers, percentiles, quality, reports
from tests.conftest import rows
from tests.fixtures import event, events_df


def _day(i, minutes=0, day=1):
    return dt.datetime(2025, 1, day, 0, 0) + dt.timedelta(minutes=minutes, seconds=i)


def test_outlier_single_row_group_kept(spark):
    df = quality.prepare(events_df(spark, [event(5.0)]))
    b = outliers.daily_bounds(df).collect()[0]
    assert b.daily_stddev is None and b.lower_bound is None
    assert outliers.remove_outliers(df).count() == 1


def test_outlier_planted_removed(spark):
    base = [event(10.0 + 0.01 * (i % 3), timestamp=_day(i), offset=i) for i in range(30)]
    df = quality.prepare(events_df(spark, base + [event(1000.0, timestamp=_day(99), offset=99)]))
    kept = outliers.remove_outliers(df)
    assert kept.count() == 30
    assert kept.filter(F.col("event_duration") == 1000.0).count() == 0
    flagged = outliers.flag_outliers(df, outliers.daily_bounds(df))
    r = outliers.outlier_rate(flagged).collect()[0]
    assert (r.outliers, r.total) == (1, 31) and r.outlier_pct == pytest.approx(100 / 31)


def test_outlier_rate_empty_is_null(spark):
    df = quality.prepare(events_df(spark, []))
    r = outliers.outlier_rate(outliers.flag_outliers(df, outliers.daily_bounds(df))).collect()[0]
    assert (r.outliers, r.total, r.outlier_pct) == (0, 0, None)


def test_threshold_counts_distinct_events(spark):
    a = [event(1.0 + (i % 7) * 0.1, device_type="door_sensor", device_id=f"door_sensor_{i % 20}",
               timestamp=_day(i), offset=i) for i in range(499)]
    # the same event delivered three more times: still one distinct event
    a += [event(1.0, device_type="door_sensor", device_id="door_sensor_0", timestamp=_day(0), offset=1000 + k)
          for k in range(3)]
    b = [event(1.0 + (i % 7) * 0.1, device_type="light_sensor", device_id=f"light_sensor_{i % 20}",
               timestamp=_day(i), offset=2000 + i) for i in range(500)]
    df = quality.prepare(events_df(spark, a + b))
    counts = dict(rows(percentiles.distinct_events(df), "device_type", "distinct_events"))
    assert counts == {"door_sensor": 499, "light_sensor": 500}
    kept = percentiles.keep_groups(df, min_events=500)
    assert rows(kept.select("device_type").distinct()) == [("light_sensor",)]
    res = percentiles.percentile_report(events_df(spark, a + b), min_events=500, as_of="2025-02-01 00:00:00")
    out = res.collect()
    assert [r.device_type for r in out] == ["light_sensor"]
    assert out[0].total_events == 500 and out[0].unique_devices == 20
    assert out[0].outlier_method == "3_standard_deviations" and out[0].min_events_threshold == 500


def test_percentiles_values(spark):
    vals = [float(v) for v in range(1, 101)]
    df = events_df(spark, [event(v, timestamp=_day(i), offset=i) for i, v in enumerate(vals)])
    r = percentiles.percentiles(quality.prepare(df)).collect()[0]
    # percentile_approx returns an element of the column (nearest rank)
    assert (r.percentile_95th, r.percentile_50th, r.percentile_75th, r.percentile_25th) == (95.0, 50.0, 75.0, 25.0)
    assert r.mean_event_duration == 50.5 and r.total_events == 100
    kll = percentiles.percentiles(quality.prepare(df), method="kll").collect()[0]
    assert kll == r


def test_result_sorted_and_rounded(spark):
    evs = []
    for d, t in [(2, "b_type"), (1, "b_type"), (1, "a_type")]:
        evs += [event(1.0 / 3 + i, device_type=t, device_id=f"{t}_{i}", timestamp=_day(i, day=d), offset=len(evs) + i)
                for i in range(3)]
    res = percentiles.percentile_report(events_df(spark, evs), min_events=3, as_of="2025-02-01 00:00:00").collect()
    assert [(r.device_type, r.event_date.day) for r in res] == [("a_type", 1), ("b_type", 1), ("b_type", 2)]
    assert res[0].mean_event_duration == 1.333


def test_count_before_outliers_option(spark):
    base = [event(10.0 + 0.01 * (i % 3), timestamp=_day(i), offset=i) for i in range(30)]
    df = events_df(spark, base + [event(1000.0, timestamp=_day(99), offset=99)])
    after = percentiles.percentile_report(df, min_events=31).count()
    before = percentiles.percentile_report(df, min_events=31, count_before_outliers=True).count()
    assert (after, before) == (0, 1)


def test_validation_report_and_empty(spark):
    res = spark.createDataFrame(
        [("a", dt.date(2025, 1, 1), 10.0, 600), ("b", dt.date(2025, 1, 1), 20.0, 700)],
        "device_type string, event_date date, percentile_95th double, total_events long")
    rep = dict(rows(reports.validation_report(res, "2025-02-01 00:00:00", 500)))
    assert rep["total_records"] == "2" and rep["avg_95th_percentile"] == "15.0"
    assert rep["total_events_processed"] == "1300" and rep["min_events_threshold"] == "500"
    assert rep["computation_date"] == "2025-02-01T00:00:00.000000+00:00"
    empty = dict(rows(reports.validation_report(res.limit(0), "2025-02-01 00:00:00")))
    assert empty["total_records"] == "0" and empty["avg_95th_percentile"] is None


def test_quantile_methods_agree_on_small_groups(spark):
    rows = [event(float((i * 37) % 101) + 0.5, device_type=f"t{i % 3}", device_id=f"t{i % 3}_{i % 7}",
                  timestamp=_day(i, minutes=i), offset=i) for i in range(900)]
    # 16 input tasks, so the KLL merge really runs over several salt buckets
    df = quality.prepare(events_df(spark, rows).repartition(16))
    cols = ["device_type", "event_date", "percentile_95th", "percentile_50th", "percentile_75th",
            "percentile_25th", "total_events", "unique_devices"]
    kll = rows_of(percentiles.percentiles(df, method="kll", buckets=4), cols)
    gk = rows_of(percentiles.percentiles(df, method="approx"), cols)
    assert kll == gk
    exact = percentiles.percentiles(df, method="exact").collect()
    assert len(exact) == len(kll)
    with pytest.raises(ValueError):
        percentiles.percentiles(df, method="median")


def rows_of(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_approx_distinct_close_to_exact(spark):
    evs = [event(1.0 + (i % 11) * 0.1, device_type="door_sensor", device_id=f"door_sensor_{i % 97}",
                  timestamp=_day(i, minutes=i), offset=i) for i in range(3000)]
    df = quality.prepare(events_df(spark, evs))
    exact = dict(rows(percentiles.distinct_events(df), "event_date", "distinct_events"))
    approx = dict(rows(percentiles.distinct_events(df, approx=True), "event_date", "distinct_events"))
    assert sum(exact.values()) == 3000 and exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) / exact[d] < 0.1 for d in exact)
    res = percentiles.percentile_report(events_df(spark, evs), min_events=100, approx_distinct=True, sort=False)
    assert res.count() == 3
