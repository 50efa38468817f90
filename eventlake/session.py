"""Session helpers: a local session for tests and tools, UTC event time, and
the shared folder (``spark.checkpoint.dir``) used for stream checkpoints and
written intermediate tables.

Library transforms never create a session; they take DataFrames.
"""

from __future__ import annotations

import logging
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "eventlake") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("EVENTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.noDataMicroBatches.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


# Settings for a large cluster (100 TB of events): many initial shuffle
# partitions that AQE coalesces to ~128 MB, skew splitting for hot keys,
# 256 MB scan splits, RocksDB for streaming state (keeps state off-heap, so
# open windows x devices do not pressure executor heaps).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # groups a task's sketch aggregate holds before it falls back to sorting (~64 KB a sketch)
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Apply ``CLUSTER_CONF`` for keys the deployment has not set itself."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        if spark.conf.get(k, None) in (None, ""):
            try:
                spark.conf.set(k, v)
            except Exception as e:  # static configuration: must come from spark-submit
                log.warning("%s is not applied (set it at submit): %s", k, str(e).split("\n")[0])


def ensure_utc(spark: SparkSession) -> None:
    """Event times are UTC instants; make day/hour extraction agree with that."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect: no SparkContext in the client
        return False


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. A
    session without the setting is a configuration error here; tools and tests
    on one machine call ``use_scratch_folder`` first."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect
            root = None
    if not root:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (e.g. an object-store URI)")
    return root.rstrip("/")


def use_scratch_folder(spark: SparkSession) -> None:
    """For the entry file, the bench and tests: where a local session names no
    shared folder, give it one of its own. Does nothing anywhere else."""
    if spark.conf.get(CHECKPOINT_CONF, None) or not is_local(spark) or spark.sparkContext.getCheckpointDir():
        return
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventlake-ckpt-"))


_WRITTEN: list[str] = []  # what this process has written to shared folders


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder."""
    path = "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])
    _WRITTEN.append(path)
    return path


def clean_shared(spark: SparkSession, after: int = 0) -> int:
    """Delete the intermediate tables this process has written to the shared
    folder, but for the first ``after`` of them; call it when no DataFrame that
    reads them is needed any more. Returns how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while len(_WRITTEN) > after:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        removed += bool(p.getFileSystem(conf).delete(p, True))
    return removed


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the intermediate tables written inside it, also after
    a failure; results must have been written elsewhere by then."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        clean_shared(spark, before)
