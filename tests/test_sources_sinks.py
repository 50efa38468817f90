"""Sources and sinks: JSON history, result writers, object-store settings,
Kafka options, bounded read and adapters."""

import json

import pytest

from eventlake.sources import kafka, objectstore
from eventlake.sources.adapters import device_events, kafka_records, read_events_table
from eventlake.sources.files import json_history, read_result
from eventlake.sources.writers import write_history, write_result
from tests.conftest import SF001, rows
from tests.fixtures import event, events_df


def test_json_history_arrays_need_multiline(spark, tmp_path):
    d = tmp_path / "historical" / "raw" / "2025" / "01" / "01" / "10"
    d.mkdir(parents=True)
    recs = [{"event_duration": 1.0 + i, "device_type": "light_sensor", "device_id": f"light_sensor_{i}",
             "timestamp": f"2025-01-01T10:0{i}:00+00:00", "location": "hall", "value": 1.0, "unit": "lux"}
            for i in range(3)]
    (d / "events.json").write_text(json.dumps(recs, indent=2))
    df = json_history(spark, str(tmp_path / "historical"), "array")
    assert df.count() == 3
    single_line = spark.read.schema(df.drop("_corrupt_record").schema).option("recursiveFileLookup", True).json(str(tmp_path / "historical"))
    assert single_line.filter("device_id IS NOT NULL").count() < 3


def test_write_history_roundtrip(spark, tmp_path):
    df = events_df(spark, [event(timestamp="2025-01-01 10:00:00", offset=0),
                           event(timestamp="2025-01-01 11:30:00", offset=1)])
    write_history(df.drop("metadata"), str(tmp_path / "h"))
    back = spark.read.json(str(tmp_path / "h"))
    assert sorted(back.select("hour").distinct().collect()) == [(10,), (11,)]
    assert back.filter("timestamp = '2025-01-01T10:00:00.000000+00:00'").count() == 1
    # several JSON lines in one file: the reader must not fall back to one object per file
    many = events_df(spark, [event(timestamp=f"2025-01-01 10:{m:02d}:00", offset=m) for m in range(30)])
    write_history(many.drop("metadata").coalesce(1), str(tmp_path / "h2"))
    hist = json_history(spark, str(tmp_path / "h2"), "lines")
    assert hist.count() == 30 and str(hist.schema["timestamp"].dataType) == "TimestampType()"


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_write_result_roundtrip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("b", 2.5), ("a", 1.25)], "device_type string, v double")
    path = str(tmp_path / f"r.{fmt}")
    write_result(df, path, fmt, sort_by=("device_type",))
    back = read_result(spark, path, fmt, schema=df.schema)
    assert [tuple(r) for r in back.collect()] == [("a", 1.25), ("b", 2.5)]
    assert len([p for p in (tmp_path / f"r.{fmt}").iterdir() if p.name.startswith("part-")]) == 1


def test_write_result_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        write_result(spark.range(1), str(tmp_path / "x"), "avro")


def test_s3a_conf_and_uri():
    conf = objectstore.s3a_conf({"AWS_ENDPOINT": "http://minio:9000", "AWS_ACCESS_KEY_ID": "k",
                                 "AWS_SECRET_ACCESS_KEY": "s"})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://minio:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert "spark.hadoop.fs.s3a.access.key" not in objectstore.s3a_conf({})
    assert objectstore.require_uri("s3a://bucket/raw/") == "s3a://bucket/raw/"
    with pytest.raises(ValueError):
        objectstore.require_uri("bucket/raw/")


def test_kafka_options():
    o = kafka.kafka_options("b:9092", "iot-events", "latest", max_offsets=100, group_id="g")
    assert o["subscribe"] == "iot-events" and o["startingOffsets"] == "latest"
    assert o["maxOffsetsPerTrigger"] == "100" and o["kafka.group.id"] == "g"
    assert o["failOnDataLoss"] == "true"
    assert kafka.kafka_options("b:9092", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_bounded_read_is_deterministic(spark):
    recs = kafka_records(read_events_table(spark, SF001))
    a = rows(kafka.bounded_read(recs, 7), "partition", "offset")
    assert len(a) == 7 and a == sorted(a)
    assert a == rows(kafka.bounded_read(recs, 7), "partition", "offset")


def test_adapter_shapes(spark):
    ev = device_events(read_events_table(spark, SF001))
    r = ev.orderBy("offset").first()
    assert r.device_id.startswith(r.device_type) and r.signal_strength == -30 - r.battery_level
    assert r.metadata["k"] == str(r.battery_level)
    assert ev.count() == 1000


def test_compact_day_keeps_rows(spark, tmp_path):
    from eventlake.plans.batch_queries import raw_lake
    from eventlake.sources.writers import compact_day

    lake = raw_lake(spark, SF001)
    compact_day(spark, lake, "2024-01-15", str(tmp_path / "c"))
    before = spark.read.parquet(lake).filter("year = 2024 AND month = 1 AND day = 15")
    after = spark.read.parquet(str(tmp_path / "c"))
    assert after.count() == before.count() > 0
    assert rows(after, "device_id", "timestamp") == rows(before, "device_id", "timestamp")


def test_cli_batch(spark, tmp_path):
    from eventlake import cli
    from eventlake.plans.batch_queries import raw_lake

    out = "file:" + str(tmp_path / "res")
    assert cli.main(["batch", "--input", "file:" + raw_lake(spark, SF001), "--output", out,
                     "--min-events", "5", "--format", "csv"]) == 0
    res = spark.read.option("header", True).csv(out + "/percentile_results.csv")
    rep = spark.read.option("header", True).csv(out + "/validation_report.csv")
    assert res.count() > 0 and rep.count() == 10
    with pytest.raises(ValueError):
        cli.main(["batch", "--input", "no/scheme", "--output", out])


def test_run_stream_requires_kafka_settings_and_connector(spark, tmp_path):
    from eventlake.sources.kafka import kafka_available
    from eventlake.streaming.stream_job import StreamConfig, run_stream

    with pytest.raises(ValueError):
        run_stream(spark, StreamConfig(str(tmp_path / "o"), str(tmp_path / "c")))
    if not kafka_available(spark):  # no connector jar in this environment
        with pytest.raises(RuntimeError, match="Kafka connector"):
            run_stream(spark, StreamConfig(str(tmp_path / "o"), str(tmp_path / "c"), "localhost:9092", "iot-events"))


def test_day_scan_on_flat_layout(spark, tmp_path):
    from pyspark.sql import functions as F

    from eventlake.sources.files import scan_events

    flat = str(tmp_path / "flat")
    device_events(read_events_table(spark, SF001)).write.parquet(flat)
    day = scan_events(spark, flat, day="2024-01-15")
    expected = spark.read.parquet(flat).filter(F.to_date("timestamp") == F.lit("2024-01-15").cast("date")).count()
    assert day.count() == expected > 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "timestamp" in plan.split("PushedFilters")[1][:200]
