"""Sharding by a two-pass external shuffle (native: DataFrame functions only).

Pass 1 scatters the rows uniformly into buckets of a size that fits in memory,
by a seeded hash. Pass 2 permutes each bucket with Spark's ``shuffle`` (a
seeded Fisher-Yates) and writes it. The buckets in order are a random order of
all rows, which is cut into shards whose row counts differ by at most one (the
law ``rows``); a shard is a run of buckets, its slots count from 0.

Scale: rows cross the network once. The hash covers the row's place in the
table besides its id and text, so a third of all rows may be equal and still
spreads evenly. Nothing is sorted globally: a row's slot is its place in the
bucket plus the number of rows in the buckets before, which come from one count
per bucket, summed in two levels. The written buckets are a table in the shared
folder; a lost executor repeats its own buckets.

Defined cases: a null text has no bytes (size 1); null and repeated ids and
repeated rows are placed one by one; very long texts make their bucket larger
by themselves only; fewer rows than shards leave shards empty; an empty table
gives no rows. Other columns are kept (``shuffle_shards``); names that the
operator adds must be free. The order repeats on reruns over the same files
with the same session settings. ``docs`` should be a table (a scan): a row's
place must not change when a task is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import quoted, stage_counted
from eventlake.operators.joins import bounded_side

BUCKET_BYTES = 4_000_000  # text of a bucket
MOST_PARTITIONS = 100_000  # of the scatter; beyond it a partition holds several buckets
RUN = 4096  # buckets whose counts one window sums


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def bucket_starts(counts: DataFrame) -> DataFrame:
    """(bucket, start) from (bucket, n): the rows of the buckets before, in two
    levels, so that no window sees more than ``RUN`` buckets or runs of them."""
    counts = counts.withColumn("run", F.floor(F.col("bucket") / RUN))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.groupBy("run").agg(F.sum("n").alias("n"))
    runs = runs.select("run", F.coalesce(F.sum("n").over(before(Window.orderBy("run"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n").over(before(Window.partitionBy("run").orderBy("bucket"))), F.lit(0))
    return counts.withColumn("inside", inside).join(runs, "run").select(
        "bucket", (F.col("base") + F.col("inside")).alias("start"))


def shuffle_shards(docs: DataFrame, shards: int = 8, seed: int = 42, text: str = "text", doc_id: str = "doc_id",
                   bucket_bytes: int = BUCKET_BYTES, prefix: str = "shard_") -> DataFrame:
    """``docs`` with columns ``<prefix>size``, ``<prefix>no`` (0 to shards - 1)
    and ``<prefix>slot`` (from 0, without gaps in a shard)."""
    names = {n: prefix + n for n in ("size", "no", "slot")}
    clash = set(names.values()) & set(docs.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}; choose another prefix")
    size = text_size(quoted(text))
    total = docs.agg(F.sum(size).alias("s")).collect()[0].s or 0
    buckets = max(-(-total // bucket_bytes), 1)

    draw = F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), quoted(doc_id), quoted(text))
    row = F.struct(*[quoted(c) for c in docs.columns], size.alias(names["size"])).alias("row")
    # pass 1: scatter
    scattered = (docs.select(draw.alias("draw"), row)
                 .select("draw", F.pmod("draw", F.lit(buckets)).alias("bucket"), "row")
                 .repartition(min(buckets, MOST_PARTITIONS), "bucket").sortWithinPartitions("bucket", "draw"))
    # pass 2: Fisher-Yates in every bucket
    order = F.shuffle(F.collect_list("row"), seed)
    placed = scattered.groupBy("bucket").agg(order.alias("rows")).select("bucket", F.posexplode("rows").alias("at", "row"))
    placed, seen = stage_counted(placed, "shard_buckets")
    n = int(seen["rows"])
    starts, fits = bounded_side(bucket_starts(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))),
                                name="shard_starts")
    place = F.col("start") + F.col("at")
    out = placed.join(F.broadcast(starts) if fits else starts, "bucket").withColumn("place", place)
    # place * shards div n, so that shard s starts at the first place of at least s * n / shards
    out = out.withColumn("no", F.expr(f"place * {shards}L div {max(n, 1)}L"))
    first = F.expr(f"(no * {n}L + {shards - 1}L) div {shards}L")
    return out.select("row.*", F.col("no").cast("int").alias(names["no"]), (F.col("place") - first).alias(names["slot"]))


def write_shards(sharded: DataFrame, path: str, prefix: str = "shard_") -> None:
    """Write the rows of ``shuffle_shards`` as one folder per shard; every file's
    rows ascend in slot, and files of one shard hold runs of slots (buckets)."""
    sharded.write.partitionBy(prefix + "no").parquet(path)


def read_shard(spark, path: str, no: int, prefix: str = "shard_") -> DataFrame:
    """The rows of one shard by slot."""
    return spark.read.parquet(path).where(F.col(prefix + "no") == no).orderBy(prefix + "slot")
