"""Command line: the batch percentile job and the streaming job.

    python -m eventlake.cli batch --input s3a://bucket/raw/ --output s3a://bucket/results/ [--day 2025-01-01]
    python -m eventlake.cli stream --servers host:9092 --topic iot-events \\
        --output s3a://bucket/lake/ --checkpoint s3a://bucket/checkpoints/

Paths must carry a scheme. Cluster settings come from spark-submit; missing
ones get the defaults of ``session.CLUSTER_CONF``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from eventlake.plans.batch_job import BatchConfig, run_batch
from eventlake.schema import MIN_EVENTS, OUTLIER_SIGMA, TRIGGER, WATERMARK, WINDOW_SIZE
from eventlake.session import apply_cluster_conf, checkpoint_root, ensure_utc, is_local, own_tables
from eventlake.sources.objectstore import require_uri, s3a_conf
from eventlake.streaming.stream_job import StreamConfig, run_stream


def _session(app: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in s3a_conf().items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not is_local(spark):
        apply_cluster_conf(spark)
    checkpoint_root(spark)  # stops here, not half way, where no shared folder is set
    ensure_utc(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="eventlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch", help="daily percentile job")
    b.add_argument("--input", required=True)
    b.add_argument("--output", required=True)
    b.add_argument("--day", help="YYYY-MM-DD")
    b.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    b.add_argument("--min-events", type=int, default=MIN_EVENTS)
    b.add_argument("--sigma", type=float, default=OUTLIER_SIGMA)
    b.add_argument("--method", choices=["exact", "kll", "approx"], default="exact",
                   help="quantile method (default exact)")
    b.add_argument("--count-before-outliers", action="store_true")
    s = sub.add_parser("stream", help="Kafka (or JSON-lines files) -> raw lake + 1-minute aggregates + quarantine")
    s.add_argument("--source", default="kafka", choices=["kafka", "files"])
    s.add_argument("--input", help="folder of JSON-lines files (--source files)")
    s.add_argument("--servers")
    s.add_argument("--topic")
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--starting", default="earliest", choices=["earliest", "latest"])
    s.add_argument("--max-offsets", type=int)
    s.add_argument("--group-id")
    s.add_argument("--trigger", default=TRIGGER)
    s.add_argument("--window", default=WINDOW_SIZE)
    s.add_argument("--watermark", default=WATERMARK)
    s.add_argument("--state-partitions", type=int)
    a = ap.parse_args(argv)

    if a.cmd == "batch":
        spark = _session("eventlake-batch")
        config = BatchConfig(require_uri(a.input), require_uri(a.output), a.day, a.format, a.min_events, a.sigma,
                             count_before_outliers=a.count_before_outliers, method=a.method)
        with own_tables(spark):
            run = run_batch(spark, config)
        print(json.dumps({"result": run.result_path, "report": run.report_path, "counts": run.counts}))
        return 0
    spark = _session("eventlake-stream")
    run_stream(spark, StreamConfig(require_uri(a.output), require_uri(a.checkpoint), a.servers, a.topic,
                                   a.starting, a.max_offsets, a.group_id, a.trigger, a.window, a.watermark,
                                   state_partitions=a.state_partitions, available_now=a.available_now,
                                   source=a.source, input_path=require_uri(a.input) if a.input else None))
    return 0


if __name__ == "__main__":
    sys.exit(main())
