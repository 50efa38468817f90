"""Batch sinks: small results, reports, the partitioned lake and JSON history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from eventlake.functions.timeparts import iso_text, with_time_parts
from eventlake.schema import TIME_PARTS
from eventlake.sources.files import day_folders

FORMATS = ("parquet", "csv", "json")


def write_result(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = True,
                 sort_by: tuple[str, ...] | None = None) -> None:
    """Overwrite ``path`` with a result in ``fmt`` (parquet/snappy, csv with
    header, json lines).

    ``single_file`` moves the rows to one task with a one-partition shuffle
    (not ``coalesce(1)``, which would pull the upstream aggregation into that
    task too) and sorts there; only for results whose size is bounded by
    (device types x days), never for event data.
    """
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported output format: {fmt}")
    out = df.repartition(1) if single_file else df
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    w = out.write.mode("overwrite")
    if fmt == "parquet":
        w.option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)


def write_partitioned(df: DataFrame, path: str, time_col: str = "timestamp", parts: tuple[str, ...] = TIME_PARTS,
                      fmt: str = "parquet", mode: str = "append", max_records_per_file: int = 5_000_000) -> None:
    """Write event rows Hive-partitioned by time parts of ``time_col``.

    The rows are rebalanced on the partition columns first: an hour's rows meet
    in one task (so in one file), small hours share a task, and adaptive
    execution splits an hour that is larger than its advisory partition size.
    Without the shuffle every task would write a file for every hour it holds.
    ``max_records_per_file`` bounds file size.
    """
    missing = [p for p in parts if p not in df.columns]
    if missing:
        df = with_time_parts(df, time_col)
    df = df.hint("rebalance", *[F.col(p) for p in parts]).sortWithinPartitions(*parts)
    (df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(*parts).format(fmt).save(path))


def to_json_edge(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text, for JSON/CSV files read by other tools."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(iso_text(F.col(f.name).cast("timestamp")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_history(df: DataFrame, path: str, time_col: str = "timestamp") -> None:
    """Hourly JSON history: one folder per ``year/month/day/hour``."""
    write_partitioned(to_json_edge(with_time_parts(df, time_col)), path, time_col, fmt="json", mode="append")


def compact_day(spark, lake: str, day: str, out: str, target_file_mb: int = 256, mode: str = "overwrite",
                files: int | None = None) -> None:
    """Rewrite all rows of one day of the raw lake into fewer, larger files
    (streams with short triggers leave many small files per hour folder).

    Every row of the day's folders is kept, whatever its timestamp. The number
    of files is the folders' size by ``target_file_mb`` (or ``files``); each
    hour gets its share of them by its rows, one at least, and a row goes to
    one of its hour's files by a hash of its place. The output goes to a new
    path; switching readers over is the caller's step.
    """
    folders = day_folders(spark, lake, day)
    if not folders:
        raise FileNotFoundError(f"no folder of {day} under {lake}")
    n = files or max(1, -(-sum(folder_bytes(spark, f) for f in folders) // (target_file_mb * 1024 * 1024)))
    df = spark.read.option("basePath", lake).parquet(*folders)
    hours = df.groupBy(*TIME_PARTS).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.col("_rows") / F.sum("_rows").over(Window.partitionBy(F.lit(1))) * F.lit(int(n))
    hours = hours.withColumn("_files", F.greatest(F.round(share), F.lit(1)).cast("int"))
    before = Window.orderBy(*TIME_PARTS).rowsBetween(Window.unboundedPreceding, -1)
    # a day has at most 24 hours (and as many strays as spellings): a small side by construction
    hours = hours.withColumn("_first", F.coalesce(F.sum("_files").over(before), F.lit(0))).drop("_rows")
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_files"))
    rows = df.join(F.broadcast(hours), list(TIME_PARTS)).withColumn("_file", F.col("_first") + spread)
    total = int(hours.agg(F.sum("_files")).first()[0] or 1)
    rows = rows.repartitionByRange(total, "_file").sortWithinPartitions("_file").drop("_first", "_files", "_file")
    rows.write.mode(mode).partitionBy(*TIME_PARTS).parquet(out)


def folder_bytes(spark, path: str) -> int:
    """Total bytes under a folder (one file-system metadata call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())
