"""Readers, writers and operators on inputs that used to lose rows or change their answer."""

import json
import os

import pytest
from pyspark.sql import functions as F

from eventlake.operators import dedup, monitoring, percentiles, quality, windows
from eventlake.plans.batch_job import BatchConfig, run_batch
from eventlake.sources.files import json_history, scan_events
from eventlake.sources.writers import compact_day, folder_bytes, write_partitioned
from tests.fixtures import event, events_df


def records(n):
    return [{"event_duration": 1.0 + i, "device_type": "t", "device_id": f"t_{i}", "value": 1.0,
             "timestamp": f"2025-01-01T10:{i:02d}:00+00:00"} for i in range(n)]


# ---------------------------------------------------------------- history
@pytest.mark.parametrize("first", ["array", "lines"])
def test_mixed_layouts_are_read_per_file(spark, tmp_path, first):
    recs = records(10)
    a, b = (json.dumps(recs[:5], indent=2), "\n".join(map(json.dumps, recs[5:])))
    (tmp_path / "x.json").write_text(a if first == "array" else b)
    (tmp_path / "y.json").write_text(b if first == "array" else a)
    df = json_history(spark, str(tmp_path), "per_file")
    assert sorted(r.device_id for r in df.collect()) == [f"t_{i}" for i in range(10)]
    assert df.filter("_corrupt_record IS NOT NULL").count() == 0


def test_corrupt_records_are_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"device_id": "x"}, broken]')
    (tmp_path / "b.json").write_text('{"device_id": "y"}\nnot json\n')
    got = {(r.device_id, r._corrupt_record) for r in json_history(spark, str(tmp_path), "per_file").collect()}
    assert got == {(None, '[{"device_id": "x"}, broken]'), ("y", None), (None, "not json")}
    wrong = json_history(spark, str(tmp_path), "array").collect()  # a file of lines is not an array
    assert all(r.device_id is None and r._corrupt_record for r in wrong) and len(wrong) == 2
    lines = json_history(spark, str(tmp_path), "lines").collect()
    assert sum(r.device_id is not None for r in lines) == 1 and len(lines) == 3


def test_layout_is_never_guessed(spark, tmp_path):
    with pytest.raises(TypeError):
        json_history(spark, str(tmp_path))
    with pytest.raises(ValueError):
        json_history(spark, str(tmp_path), "auto")


# ---------------------------------------------------------------- day folders
def lake(spark, path, folder, rows):
    events_df(spark, rows).withColumn("hour", F.hour("timestamp")).write.partitionBy("hour").parquet(f"{path}/{folder}")


def test_every_spelling_of_a_day_is_read(spark, tmp_path):
    p = str(tmp_path)
    lake(spark, p, "year=2025/month=1/day=2", [event(timestamp="2025-01-02 10:00:00", offset=0)])
    lake(spark, p, "year=2025/month=01/day=02", [event(timestamp="2025-01-02 11:00:00", offset=1)])
    lake(spark, p, "year=2025/month=01/day=03", [event(timestamp="2025-01-03 11:00:00", offset=2)])
    assert scan_events(spark, p, day="2025-01-02").count() == 2
    compact_day(spark, p, "2025-01-02", p + "-c")
    assert spark.read.parquet(p + "-c").count() == 2


def test_compaction_keeps_rows_of_any_time(spark, tmp_path):
    """A folder partitioned by arrival, as the quarantine's is."""
    p = str(tmp_path / "q")
    rows = events_df(spark, [event(timestamp="2025-01-01 10:00:00", offset=0),
                             event(timestamp="2024-12-31 23:00:00", offset=1),
                             event(timestamp="2025-01-01 10:00:00", offset=2)])
    rows = rows.withColumn("timestamp", F.when(F.col("offset") < 2, F.col("timestamp")))
    parts = {"year": 2025, "month": 1, "day": 1, "hour": 10}
    rows.select("*", *[F.lit(v).alias(k) for k, v in parts.items()]).write.partitionBy(*parts).parquet(p)
    compact_day(spark, p, "2025-01-01", p + "-c")
    assert sorted(r.offset for r in spark.read.parquet(p + "-c").collect()) == [0, 1, 2]


def data_files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")]


def many_hours(spark, hours=48, per_hour=40, tasks=16):
    start = F.lit("2025-01-01 00:00:00").cast("timestamp")
    df = spark.range(hours * per_hour).repartition(tasks)
    at = F.timestamp_micros(F.unix_micros(start) + (F.col("id") % hours) * 3_600_000_000)
    return df.select(F.col("id").alias("offset"), at.alias("timestamp"))


def test_partitioned_write_makes_about_one_file_an_hour(spark, tmp_path):
    write_partitioned(many_hours(spark), str(tmp_path / "w"))
    assert spark.read.parquet(str(tmp_path / "w")).count() == 48 * 40
    assert 48 <= len(data_files(tmp_path / "w")) <= 72


def test_compaction_meets_its_target_and_splits_a_hot_hour(spark, tmp_path):
    df = many_hours(spark, hours=24, per_hour=100)
    hot = many_hours(spark, hours=1, per_hour=4800).withColumn("offset", F.col("offset") + 100_000)
    write_partitioned(df.union(hot), str(tmp_path / "w"))
    compact_day(spark, str(tmp_path / "w"), "2025-01-01", str(tmp_path / "c"), files=48)
    files = data_files(tmp_path / "c")
    assert spark.read.parquet(str(tmp_path / "c")).count() == 24 * 100 + 4800
    assert 40 <= len(files) <= 60
    assert sum("hour=0/" in f for f in files) >= 20


def test_unknown_size_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        folder_bytes(spark, "nosuchscheme://x/y")
    with pytest.raises(FileNotFoundError):
        compact_day(spark, str(tmp_path), "2025-01-01", str(tmp_path / "c"))


# ---------------------------------------------------------------- empty results
@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
@pytest.mark.parametrize("case", ["no group kept", "empty day"])
def test_batch_job_finishes_without_results(spark, tmp_path, fmt, case):
    p = str(tmp_path / "lake")
    write_partitioned(events_df(spark, [event(timestamp=f"2025-01-01 10:0{i}:00", offset=i) for i in range(5)]), p)
    cfg = BatchConfig(p, str(tmp_path / "out"), fmt=fmt, min_events=10**6 if case == "no group kept" else 1,
                      day=None if case == "no group kept" else "2025-01-02")
    run = run_batch(spark, cfg)
    assert run.counts["result_rows"] == run.counts["events_in_result"] == 0
    assert run.counts["input_rows"] == (5 if case == "no group kept" else 0)
    report = {r.metric: r.value for r in spark.read.option("header", True).csv(run.report_path).collect()}
    assert report["total_records"] == "0" and len(report) == 10


# ---------------------------------------------------------------- percentiles
def disc(values, p):
    import math

    return sorted(values)[max(math.ceil(p * len(values) - 1e-9), 1) - 1]


def test_large_groups_are_exact_and_repeatable(spark):
    n = 200_000
    df = spark.range(n).select(
        F.lit("t").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7.0).alias("event_duration"),
        F.col("id").cast("string").alias("device_id"), F.timestamp_seconds("id").alias("timestamp"))
    values = [r[0] for r in df.select("event_duration").collect()]
    expected = tuple(disc(values, p) for p in (0.95, 0.5, 0.75, 0.25))
    for parts, select_rows in ((4, 1_000_000), (13, 2_000)):
        got = percentiles.percentiles(df.repartition(parts), by=("g",), digits=None, k=256, select_rows=select_rows).first()
        assert (got.percentile_95th, got.percentile_50th, got.percentile_75th, got.percentile_25th) == expected
        assert got.total_events == got.unique_devices == n


def test_ties_and_small_groups_beside_a_large_one(spark):
    rows = [("big", float(v)) for v in [1, 2] * 3000] + [("big", 5.0)] + [("small", 3.0), ("small", float("nan"))]
    df = spark.createDataFrame(rows, "g string, event_duration double").withColumns(
        {"device_id": F.lit("d"), "timestamp": F.lit("2025-01-01").cast("timestamp")})
    got = {r.g: r for r in percentiles.percentiles(df.repartition(8), by=("g",), k=64, select_rows=50, digits=None).collect()}
    assert (got["big"].percentile_25th, got["big"].percentile_50th, got["big"].percentile_95th) == (1.0, 2.0, 2.0)
    assert (got["small"].percentile_50th, got["small"].total_events, got["small"].stddev_event_duration) == (3.0, 1, None)


def test_distinct_counts_need_no_expand(spark):
    df = events_df(spark, [event(offset=i, device_id=f"d{i % 3}") for i in range(9)] + [event(offset=99, device_id=None)])
    out = percentiles.distinct_counts(df, ("device_type",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Scan") <= 1
    r = out.first()
    assert (r.unique_devices, r.distinct_events) == (3, df.select("device_id", "timestamp").dropna().distinct().count())


# ---------------------------------------------------------------- windows, de-dup, failures
def test_attributes_without_offsets(spark):
    rows = [event(timestamp="2025-01-01 10:00:05", offset=None, location="late"),
            event(timestamp="2025-01-01 10:00:01", offset=None, location="early")]
    for agg in (windows.minute_agg_by_device, windows.hourly_agg):
        r = agg(events_df(spark, rows)).first()
        assert r.location == "early" and r.device_type is not None and r.unit is not None
    with_offset = windows.hourly_agg(events_df(spark, [*rows, event(timestamp="2025-01-01 10:00:30", offset=7, location="known")]))
    assert with_offset.first().location == "known"


def test_null_keys_are_not_merged(spark):
    df = events_df(spark, [event(offset=0, device_id=None), event(offset=1, device_id=None), event(offset=3),
                           event(offset=2)])
    got = dedup.dedup(df)
    assert got.columns == df.columns and sorted(r.offset for r in got.collect()) == [0, 1, 2]
    assert sorted(r.offset for r in dedup.dedup(df, order_by=None).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        dedup.dedup(df, emit="sometimes")


def test_failures_without_a_time_are_counted(spark):
    df = events_df(spark, [event(offset=i) for i in range(4)])
    df = df.withColumn("timestamp", F.when(F.col("offset") > 1, F.col("timestamp")))
    df = df.withColumn("kafka_timestamp", F.lit("2025-01-01 10:07:00").cast("timestamp"))
    wide = {r.reason: r.failures for r in monitoring.failure_rate(df).collect()}
    exploded = monitoring.failure_rate(quality.apply_rules(df)).collect()
    assert wide == {"missing_timestamp": 2} == {r.reason: r.failures for r in exploded}
    assert str(exploded[0].window_start) == "2025-01-01 10:05:00" and str(exploded[0].window_end) == "2025-01-01 10:10:00"
    no_time = monitoring.failure_rate(df.drop("kafka_timestamp")).collect()
    assert [(r.window_start, r.failures) for r in no_time] == [(None, 2)]
