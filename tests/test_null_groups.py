"""Rows with null group keys, and groups without values, are never lost."""

import math
import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators import joins, outliers, percentiles

SCHEMA = "location string, device_id string, timestamp timestamp_ntz, event_duration double"


def frame(spark, rows):
    df = spark.createDataFrame([(g, f"d{i % 4}", i, v) for i, (g, v) in enumerate(rows)],
                               "location string, device_id string, at long, event_duration double")
    return df.select("location", "device_id", F.timestamp_seconds("at").alias("timestamp"), "event_duration")


def disc(values, p):
    values = sorted(values)
    return values[max(math.ceil(len(values) * p - 1e-9), 1) - 1]


@pytest.mark.parametrize("k,select_rows", [(8192, 10**6), (16, 10**6), (16, 5)])
def test_null_and_valueless_groups(spark, k, select_rows):
    rnd = random.Random(5)
    values = {None: [rnd.random() for _ in range(200)], "x": [float(rnd.randint(0, 9)) for _ in range(300)],
              "nan": [math.nan] * 30, "null": [None] * 20,
              "wide": [rnd.choice([-1, 1]) * 10.0 ** rnd.randint(-300, 300) for _ in range(200)],
              "inf": [math.inf] * 40 + [-math.inf] * 40 + [1.0] * 50}
    rows = [(g, v) for g, vs in values.items() for v in vs]
    rnd.shuffle(rows)
    got = {r.location: r for r in percentiles.percentiles(
        frame(spark, rows).repartition(5), by=("location",), k=k, select_rows=select_rows, digits=None,
        with_distinct_events=True).collect()}
    assert set(got) == set(values)
    for g, vs in values.items():
        some = [v for v in vs if v is not None and not math.isnan(v)]
        r = got[g]
        assert r.total_events == len(some) and r.distinct_events == len(vs) and r.unique_devices == 4
        for p in (0.25, 0.5, 0.75, 0.95):
            assert r[percentiles.percentile_name(p)] == (disc(some, p) if some else None)
    assert got["nan"].mean_event_duration is None and got["x"].mean_event_duration == pytest.approx(
        sum(values["x"]) / 300)


def test_a_sketch_that_misses_is_mended(spark, monkeypatch):
    """Intervals that do not hold their rank become wider until they do."""
    monkeypatch.setattr(percentiles, "rank_error", lambda k: -0.2)  # ends crossed: nothing is inside
    values = [float(i % 977) for i in range(3000)]
    got = percentiles.percentiles(frame(spark, [(None, v) for v in values]), by=("location",), k=16, digits=None).first()
    assert [got[percentiles.percentile_name(p)] for p in (0.25, 0.5, 0.75, 0.95)] == [
        disc(values, p) for p in (0.25, 0.5, 0.75, 0.95)]


def test_outliers_and_thresholds_keep_null_groups(spark):
    rows = [(None, 1.0)] * 40 + [("x", 2.0)] * 60 + [(None, 500.0)]
    df = frame(spark, rows)
    kept = outliers.remove_outliers(df, by=["location"])
    assert {r.location: r["count"] for r in kept.groupBy("location").count().collect()} == {None: 40, "x": 60}
    assert percentiles.keep_groups(df, by=["location"], min_events=41).count() == 101
    assert percentiles.keep_groups(df, by=["location"], min_events=60).count() == 60
    by = ["location", "day"]
    dated = df.withColumn("day", F.when(F.col("device_id") != "d0", F.lit("2025-01-01")))
    assert percentiles.percentiles(dated, by=by).agg(F.sum("total_events")).first()[0] == 101


def test_null_safe_join_forms(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, _k_other int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, v int")
    for broadcast in (False, True):
        got = joins.null_safe_join(left, right, ["k"], "left", broadcast)
        assert got.columns == ["k", "_k_other", "v"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted([(None, 1, 10), ("a", 2, 20), ("b", 3, None)], key=str)
    assert joins.null_safe_join(left, right, ["k"], "left_semi").count() == 2
