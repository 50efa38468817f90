"""File sources: the raw Parquet lake, JSON history, result re-reads and a
file-based stream source (the stand-in for Kafka in tests)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventlake.functions.parse import CORRUPT_COLUMN, parse_iso
from eventlake.functions.timeparts import day_predicate
from eventlake.schema import EVENT_SCHEMA, PERCENTILE_INPUT_COLUMNS, TIME_PARTS
from eventlake.session import ensure_utc


def day_folders(spark: SparkSession, path: str, day: str) -> list[str]:
    """The existing folders of a day, in every spelling (``month=1``, ``month=01``):
    writers of both forms may share a lake."""
    y, m, d = (int(x) for x in day.split("-"))
    months, days = {str(m), f"{m:02d}"}, {str(d), f"{d:02d}"}
    found = [f"{path.rstrip('/')}/year={y}/month={a}/day={b}" for a in sorted(months) for b in sorted(days)]
    return [f for f in found if path_exists(spark, f)]


def path_exists(spark: SparkSession, path: str) -> bool:
    """One file-system metadata call."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def scan_events(
    spark: SparkSession,
    path: str,
    day: str | None = None,
    columns: tuple[str, ...] | None = PERCENTILE_INPUT_COLUMNS,
    schema: StructType | None = None,
) -> DataFrame:
    """Scan the raw event lake (Parquet, optionally ``year/month/day/hour``
    partitioned).

    Only ``columns`` are read (column pruning). With ``day`` (``YYYY-MM-DD``)
    on the partitioned lake only that day's folders are listed and read (in
    every spelling; ``basePath`` keeps the partition columns), so the cost does
    not grow with the years of history next to it; the timestamp predicate is
    still pushed to the Parquet reader. On a flat layout the day becomes a
    pushed timestamp range.
    """
    ensure_utc(spark)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    folders = day_folders(spark, path, day) if day is not None else []
    if folders:
        df = reader.option("basePath", path).parquet(*folders)
    else:
        df = reader.parquet(path)
    partitioned = all(p in df.columns for p in TIME_PARTS[:3])
    if day is not None:
        df = df.filter(day_predicate(day, "timestamp", partitioned=partitioned))
    if columns is not None:
        df = df.select(*columns)
    return df


HISTORY_LAYOUTS = ("per_file", "array", "lines")


def json_records(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """One row per JSON record of nested history folders: its text (``record``)
    and whether it is known not to be one (``bad``).

    ``lines``: one record per line; files are split between tasks.
    ``array``: one JSON array per file (the hourly upload format), read whole;
    a file that is not an array is one (corrupt) record.
    ``per_file``: each file is read whole and decided by itself.
    """
    if layout not in HISTORY_LAYOUTS:
        raise ValueError(f"layout must be one of {HISTORY_LAYOUTS}")
    reader = spark.read.option("recursiveFileLookup", True)
    if layout == "lines":
        text = reader.text(path).select(F.col("value").alias("record")).filter(F.trim("record") != "")
        return text.withColumn("bad", F.col("record").rlike(r"^\s*\["))  # an array is not a record
    files = reader.text(path, wholetext=True).filter(F.col("value").rlike(r"\S"))

    def as_records(texts: Column, bad: bool) -> Column:
        return F.transform(texts, lambda x: F.struct(x.alias("record"), F.lit(bad).alias("bad")))

    is_array = F.col("value").rlike(r"^\s*\[")
    # elements keep their own text, so that a bad one does not lose its neighbours
    items = F.when(is_array, as_records(F.from_json("value", "array<string>"), False))
    if layout == "per_file":
        lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
        items = F.coalesce(items, F.when(~is_array, as_records(lines, False)))
    records = F.coalesce(items, as_records(F.array("value"), True))
    return files.select(F.explode(records).alias("r")).select("r.record", "r.bad")


def json_history(spark: SparkSession, path: str, layout: str, schema: StructType = EVENT_SCHEMA,
                 parse_times: bool = True) -> DataFrame:
    """Hourly history files in nested folders (``json_records``), typed by
    ``schema``. Records that are not valid JSON objects of the schema are kept:
    their fields are null and ``_corrupt_record`` holds their text. With
    ``parse_times`` a string ``timestamp`` becomes TIMESTAMP."""
    parse_schema = StructType([*schema.fields, StructField(CORRUPT_COLUMN, StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    # out of a generator, so that each record is parsed once (see parse_kafka_json)
    parsed = F.when(~F.col("bad"), F.from_json("record", parse_schema, options))
    once = F.inline(F.array(F.struct(parsed.alias("data"), F.col("record").alias("_record"))))
    df = json_records(spark, path, layout).select(once)
    names = schema.fieldNames()
    bad = F.when(F.col("data").isNull(), F.col("_record")).otherwise(F.col(f"data.{CORRUPT_COLUMN}"))
    df = df.select(*[F.col(f"data.`{n}`").alias(n) for n in names], bad.alias(CORRUPT_COLUMN))
    if parse_times and "timestamp" in names and schema["timestamp"].dataType.simpleString() == "string":
        df = df.withColumn("timestamp", parse_iso("timestamp"))
    return df


def read_result(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Re-read a written result (``write_result``) in its format."""
    fmt = fmt.lower()
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    if fmt == "json":
        return reader.json(path)
    raise ValueError(f"Unsupported output format: {fmt}")


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming DataFrame over files arriving in ``path`` (oldest first)."""
    ensure_utc(spark)
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def json_lines_records(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       topic: str = "files") -> DataFrame:
    """A stream of JSON-lines files (one event per line) shaped like Kafka
    records, so the streaming job runs unchanged without a broker: ``value``
    is the line, ``timestamp`` the micro-batch time, ``partition`` 0 and
    ``offset`` null. Files carry no offsets, so lag and order questions have no
    meaning on this source; first-event attributes fall back to event time."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    lines = reader.load(path)
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
