"""The stream job with one read of the source; lag and open windows of a query."""

from pyspark.sql import functions as F

from eventlake.operators import monitoring, windows
from eventlake.operators.quality import quality_events
from eventlake.sources.adapters import device_events, kafka_records, read_events_table
from eventlake.streaming.progress import attach, progress_frame
from eventlake.streaming.state import open_windows, plain_path, processed_files
from eventlake.streaming.sinks import stream_parquet
from eventlake.streaming.stream_job import StreamConfig, start_landed
from tests.conftest import SF001


def run(spark, stream, cfg):
    for q in start_landed(spark, stream, cfg, land_first=True):
        q.awaitTermination()
        assert q.exception() is None


def test_source_is_read_once_and_a_restart_adds_only_new_rows(spark, tmp_path):
    import time

    events = read_events_table(spark, SF001)
    recs = kafka_records(events)
    half = F.col("offset") < 500
    recs.filter(half).write.parquet(str(tmp_path / "topic" / "batch=0"))
    stream = spark.readStream.schema(recs.schema).parquet(str(tmp_path / "topic"))
    lake = str(tmp_path / "lake")
    cfg = StreamConfig(lake, str(tmp_path / "ck"), available_now=True, state_partitions=2)
    collector = attach(spark)
    for _ in range(2):  # the second start finds nothing new
        run(spark, stream, cfg)
        assert spark.read.parquet(f"{lake}/landed").count() == recs.filter(half).count()
    recs.filter(~half).write.parquet(str(tmp_path / "topic" / "batch=1"))
    run(spark, stream, cfg)
    raw, bad = spark.read.parquet(f"{lake}/raw"), spark.read.parquet(f"{lake}/quarantine")
    assert raw.count() == 921 == raw.select("offset").distinct().count()
    assert bad.count() == 79 and bad.filter("raw_payload is null or size(reject_reasons) = 0").count() == 0
    assert {"year", "hour", "processing_timestamp", "is_valid_battery"} <= set(raw.columns)
    deadline = time.time() + 15
    while time.time() < deadline:
        pf = progress_frame(spark, collector.reports()).filter("name = 'landed'")
        if (pf.agg(F.sum("num_input_rows")).first()[0] or 0) >= 1000:
            break
        time.sleep(0.3)
    spark.streams.removeListener(collector)
    assert pf.agg(F.sum("num_input_rows")).first()[0] == 1000  # each record once, over all starts


def test_open_windows_complete_the_batch_aggregate(spark, tmp_path):
    events = read_events_table(spark, SF001)
    events.write.parquet(str(tmp_path / "in" / "batch=0"))
    stream = device_events(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    q = stream_parquet(windows.minute_agg(quality_events(stream), size="1 day", watermark="2 days"),
                       str(tmp_path / "out"), str(tmp_path / "ck"), parts=(), available_now=True)
    q.awaitTermination()
    batch = windows.minute_agg(quality_events(device_events(events)), size="1 day")
    open_ = open_windows(spark, str(tmp_path / "ck"))
    emitted = spark.read.parquet(str(tmp_path / "out"))
    assert open_.count() > 0 and emitted.count() > 0 and set(open_.columns) == set(batch.columns)
    both = emitted.unionByName(open_)
    key = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r)
                            for r in df.select(*batch.columns).collect())
    assert key(both) == key(batch)


def test_file_lag(spark, tmp_path):
    inbox, ck = str(tmp_path / "in box"), str(tmp_path / "ck")
    rows = spark.createDataFrame([("t", 0, i) for i in range(5)] + [(None, None, 9)], "topic string, partition int, offset long")
    rows.write.parquet(f"{inbox}/a=0")
    stream = spark.readStream.schema(rows.schema).parquet(inbox)
    stream_parquet(stream, str(tmp_path / "out"), ck, parts=(), available_now=True).awaitTermination()
    spark.createDataFrame([("t", 0, 5), ("t", 0, 6), ("u", 1, 0)], rows.schema).write.parquet(f"{inbox}/a=1")
    present = spark.read.schema(rows.schema).parquet(inbox).select(
        "topic", "partition", "offset", plain_path(F.col("_metadata.file_path")).alias("path"))
    got = {tuple(r) for r in monitoring.file_lag(present, processed_files(spark, ck)).collect()}
    assert got == {("t", 0, 6, 4, 2), ("u", 1, 0, None, 1), (None, None, 9, 9, 0)}
