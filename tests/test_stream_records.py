"""What the stream job keeps of rejected records, progress history, scratch folders."""

import json

import pytest
from pyspark.errors import AnalysisException

from eventlake import session
from eventlake.functions.parse import parse_kafka_json
from eventlake.operators.joins import bounded_side
from eventlake.streaming.progress import ProgressCollector, read_progress
from eventlake.streaming.stream_job import StreamConfig, quarantine_stream, run_stream


def records(spark, values):
    rows = [(b"k", v.encode(), "t", 0, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long").selectExpr(
        "*", "timestamp'2025-01-01 10:00:00' AS timestamp")


GOOD = {"event_duration": 1.0, "device_type": "t", "device_id": "t_1", "timestamp": "2025-01-01T10:00:00Z", "value": 2.0}


def test_quarantine_keeps_payload_and_time_text(spark):
    bad_time = json.dumps({**GOOD, "timestamp": "soon"})
    got = {r.offset: r for r in quarantine_stream(records(spark, [json.dumps(GOOD), bad_time, "{cut"])).collect()}
    assert set(got) == {1, 2}
    assert got[1].raw_payload == bad_time and got[1].timestamp_text == "soon" and got[1].timestamp is None
    assert got[2].raw_payload == "{cut" and "malformed_json" in got[2].reject_reasons
    assert "raw_payload" not in parse_kafka_json(records(spark, ["{}"])).columns


def test_progress_reports_are_all_kept(spark, tmp_path):
    class Event:
        def __init__(self, i):
            self.progress = type("P", (), {"json": json.dumps({"id": "q", "batchId": i, "numInputRows": 2})})()

    collector, table = ProgressCollector(), str(tmp_path / "progress")
    for i in range(1500):
        collector.onQueryProgress(Event(i))
        if i == 700:
            assert collector.flush(spark, table) == 701
    assert collector.flush(spark, table) == 799 and collector.flush(spark, table) == 0
    got = read_progress(spark, table)
    assert got.count() == 1500 and got.agg({"num_input_rows": "sum"}).first()[0] == 3000


def test_a_stream_that_does_not_finish_in_time_is_an_error(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for i in range(40):
        (inbox / f"{i}.json").write_text(json.dumps(GOOD) + "\n")
    cfg = StreamConfig(str(tmp_path / "o"), str(tmp_path / "c"), source="files", input_path=str(inbox), max_offsets=1,
                       available_now=True)
    with pytest.raises(TimeoutError):
        run_stream(spark, cfg, timeout_s=0.01)


def test_broadcast_is_bounded_by_bytes(spark):
    long = spark.range(50).selectExpr("repeat('x', 10000) AS k", "id")
    assert bounded_side(long, max_rows=100, max_bytes=10**6)[1]
    assert not bounded_side(long, max_rows=100, max_bytes=400_000)[1]
    assert not bounded_side(long, max_rows=10)[1]


def test_shared_tables_can_be_removed(spark, tmp_path):
    before, session._WRITTEN[:] = list(session._WRITTEN), []
    try:
        table, _ = bounded_side(spark.range(3))
        path = session._WRITTEN[-1]
        with session.own_tables(spark):
            inner = session.shared_path(spark, "inner")
            spark.range(2).write.parquet(inner)
        with pytest.raises(AnalysisException):
            spark.read.parquet(inner)
        assert table.count() == 3 and session.clean_shared(spark) == 1
        assert not spark.sparkContext._jvm.java.io.File(path.removeprefix("file:")).exists()
    finally:
        session._WRITTEN[:] = before


def test_without_a_shared_folder_the_library_stops():
    class Bare:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_path(Bare(), "x")


def test_rest_works_without_the_training_data_subpackage(tmp_path):
    """The library, its entry file and its registry when the optional folders are deleted."""
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    shutil.copytree(root / "eventlake", tmp_path / "eventlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q); print(len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[-1]) >= 60
