"""Structured Streaming: watermark, late rows, restart, de-duplication and
batch = stream for closed windows. File source + Parquet sink, one file per
micro-batch."""

import datetime as dt

from pyspark.sql import functions as F

from eventlake.operators import dedup, windows
from eventlake.operators.quality import quality_events
from eventlake.streaming.sinks import stop_gracefully, stream_memory, stream_parquet
from eventlake.streaming.stream_job import raw_output
from tests.conftest import rows
from tests.fixtures import EVENT_ROW, event, events_df


def _stream(spark, folder):
    return spark.readStream.schema(EVENT_ROW).option("maxFilesPerTrigger", 1).parquet(str(folder))


def _drop(spark, folder, i, times, start=0):
    evs = [event(timestamp=t, offset=start + k) for k, t in enumerate(times)]
    events_df(spark, evs).coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={i:03d}")


def _run(df, out, ck, **kw):
    q = stream_parquet(df, str(out), str(ck), available_now=True, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_late_rows_dropped_from_windows(spark, tmp_path):
    inbox = tmp_path / "in"
    batches = [["2025-01-01 10:00:10", "2025-01-01 10:10:00"], ["2025-01-01 10:10:10"],
               ["2025-01-01 10:00:20", "2025-01-01 10:09:30"], ["2025-01-01 10:30:00"]]
    out, ck = tmp_path / "out", tmp_path / "ck"
    dropped = []
    for i, b in enumerate(batches):
        _drop(spark, inbox, i, b, start=10 * i)
        agg = windows.minute_agg(quality_events(_stream(spark, inbox)), watermark="2 minutes")
        q = _run(agg, out, ck, parts=())
        dropped.append(sum(so.numRowsDroppedByWatermark for p in q.recentProgress for so in p.stateOperators))
    got = rows(spark.read.parquet(str(out)).select(F.date_format("window_start", "HH:mm"), "event_count"))
    assert got == [("10:00", 1), ("10:09", 1), ("10:10", 2)]
    # only the third batch (10:00:20 after the watermark reached 10:08:10) drops a row
    assert dropped[2] > 0 and dropped[0] == dropped[1] == dropped[3] == 0
    # the raw branch has no watermark: the late row is kept there
    raw_out, raw_ck = tmp_path / "raw", tmp_path / "raw_ck"
    _run(raw_output(quality_events(_stream(spark, inbox))), raw_out, raw_ck)
    assert spark.read.parquet(str(raw_out)).count() == 6


def test_restart_no_duplicates_no_gaps(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    _drop(spark, inbox, 0, ["2025-01-01 10:00:00", "2025-01-01 10:00:01"], start=0)
    _drop(spark, inbox, 1, ["2025-01-01 10:01:00"], start=10)
    _run(raw_output(quality_events(_stream(spark, inbox))), out, ck)
    _drop(spark, inbox, 2, ["2025-01-01 10:02:00", "2025-01-01 10:02:01"], start=20)
    _run(raw_output(quality_events(_stream(spark, inbox))), out, ck)
    got = rows(spark.read.parquet(str(out)), "offset")
    assert got == [(0,), (1,), (10,), (20,), (21,)]


def test_dedup_within_watermark(spark, tmp_path):
    inbox = tmp_path / "in"
    _drop(spark, inbox, 0, ["2025-01-01 10:00:00", "2025-01-01 10:00:00", "2025-01-01 10:00:05"], start=0)
    _drop(spark, inbox, 1, ["2025-01-01 10:00:05", "2025-01-01 10:01:00"], start=10)
    _drop(spark, inbox, 2, ["2025-01-01 10:10:00"], start=20)
    s = _stream(spark, inbox).select("device_id", "timestamp", "offset")
    # emitted at once, first copy per key
    _run(dedup.dedup(s, watermark="2 minutes", emit="immediately"), tmp_path / "o1", tmp_path / "c1", parts=())
    got = rows(spark.read.parquet(str(tmp_path / "o1")), "timestamp")
    assert [str(t[0])[11:] for t in got] == ["10:00:00", "10:00:05", "10:01:00", "10:10:00"]
    # combined before the shuffle, emitted when the watermark (10:08) passes the key
    _run(dedup.dedup(s, watermark="2 minutes", emit="on_watermark"), tmp_path / "o2", tmp_path / "c2", parts=())
    got = rows(spark.read.parquet(str(tmp_path / "o2")), "timestamp", "offset")
    assert [(str(t)[11:], o) for t, o in got] == [("10:00:00", 0), ("10:00:05", 2), ("10:01:00", 11)]


def test_equal_copies_of_a_hot_key_are_spread(spark, tmp_path):
    inbox = tmp_path / "in"
    for i in range(4):
        _drop(spark, inbox, i, ["2025-01-01 10:00:00"] * 5, start=0)
    s = _stream(spark, inbox).select("device_id", "timestamp").repartition(4)
    q = (dedup.dedup(s, watermark="2 minutes").writeStream.format("memory").queryName("hot_copies")
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("hot_copies").count() == 1
    kept = [max(p["stateOperators"][i]["numRowsTotal"] for p in q.recentProgress) for i in (0, 1)]
    assert sorted(kept)[0] == 1 < sorted(kept)[1]  # one per salt first, then one


def test_dedup_batch_keeps_first_copy(spark):
    df = events_df(spark, [event(value=float(i), timestamp="2025-01-01 10:00:00", offset=10 - i) for i in range(5)])
    out = dedup.dedup(df).collect()
    assert len(out) == 1 and out[0].offset == 6 and out[0].value == 4.0


def test_batch_equals_stream_for_closed_windows(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    base = dt.datetime(2025, 1, 1, 10, 0)
    times = [base + dt.timedelta(seconds=17 * k) for k in range(40)]
    evs = [event(value=float(k), device_id=f"temperature_sensor_{k % 3}", timestamp=t, offset=k)
           for k, t in enumerate(times)]
    events_df(spark, evs).coalesce(1).write.parquet(f"{inbox}/batch=000")
    _run(windows.minute_agg(quality_events(_stream(spark, inbox)), watermark="2 minutes"), out, ck, parts=())
    streamed = spark.read.parquet(str(out))
    wm = max(times) - dt.timedelta(minutes=2)
    batch = windows.minute_agg(quality_events(events_df(spark, evs))).filter(f"window_end <= '{wm}'")
    cols = ["window_start", "device_id", "event_count", "avg_value", "stddev_value", "low_battery_count"]
    assert rows(streamed, *cols) == rows(batch, *cols)


def test_memory_sink_and_graceful_stop(spark, tmp_path):
    inbox = tmp_path / "in"
    _drop(spark, inbox, 0, ["2025-01-01 10:00:00"])
    q = stream_memory(_stream(spark, inbox).select("offset"), "eventlake_mem_test")
    q.awaitTermination()
    assert spark.table("eventlake_mem_test").count() == 1
    assert stop_gracefully(q, 10)


def test_stream_job_two_queries_from_kafka_records(spark, tmp_path):
    """Raw-lake, aggregate and quarantine queries started from
    one parsed Kafka stream (file-backed stand-in for the topic)."""
    import time

    from eventlake.sources.adapters import kafka_records, read_events_table
    from eventlake.streaming.progress import attach, progress_frame
    from eventlake.streaming.stream_job import StreamConfig, start_queries
    from tests.conftest import SF001

    recs = kafka_records(read_events_table(spark, SF001))
    recs.write.parquet(str(tmp_path / "topic" / "batch=0"))
    stream = spark.readStream.schema(recs.schema).parquet(str(tmp_path / "topic"))
    collector = attach(spark)
    cfg = StreamConfig(str(tmp_path / "lake"), str(tmp_path / "ck"), available_now=True, state_partitions=4)
    queries = start_queries(spark, stream, cfg)
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None
    raw = spark.read.parquet(str(tmp_path / "lake" / "raw"))
    agg = spark.read.parquet(str(tmp_path / "lake" / "aggregated"))
    assert raw.count() == 921  # valid rows of sf0.001 under the lenient rules (DuckDB count)
    assert {"year", "month", "day", "hour", "processing_timestamp", "is_valid_battery"} <= set(raw.columns)
    assert agg.count() > 0 and agg.agg({"event_count": "sum"}).first()[0] <= 921
    bad = spark.read.parquet(str(tmp_path / "lake" / "quarantine"))
    assert bad.count() == 1000 - 921  # every rejected row kept, with its reasons
    assert bad.filter("size(reject_reasons) = 0").count() == 0
    deadline = time.time() + 15
    while time.time() < deadline and len(collector.reports()) < 3:
        time.sleep(0.5)
    spark.streams.removeListener(collector)
    pf = progress_frame(spark, collector.reports())
    assert pf.filter("num_input_rows > 0").count() >= 3


def test_cli_stream_from_json_lines_files(spark, tmp_path):
    """The whole stream job without a broker: JSON-lines files as records."""
    import json

    from eventlake import cli

    inbox = tmp_path / "in"
    inbox.mkdir()
    good = {"event_duration": 1.5, "device_type": "door_sensor", "device_id": "door_sensor_1",
            "timestamp": "2025-01-01T10:00:00+00:00", "location": "hall", "value": 1.0, "unit": "state"}
    lines = [json.dumps(dict(good, timestamp=f"2025-01-01T10:{m:02d}:00+00:00")) for m in range(10)]
    lines += ["{broken", json.dumps(dict(good, battery_level=500))]
    (inbox / "part-0.json").write_text("\n".join(lines) + "\n")
    out, ck = "file:" + str(tmp_path / "lake"), "file:" + str(tmp_path / "ck")
    assert cli.main(["stream", "--source", "files", "--input", "file:" + str(inbox), "--output", out,
                     "--checkpoint", ck, "--available-now", "--state-partitions", "2"]) == 0
    assert spark.read.parquet(out + "/raw").count() == 10
    bad = spark.read.parquet(out + "/quarantine")
    assert bad.count() == 2
    assert spark.read.parquet(out + "/aggregated").count() == 7  # windows ending by 10:07 (= 10:09 - 2 min)
