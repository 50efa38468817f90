"""De-duplication of redelivered events (delivery is at-least-once)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("device_id", "timestamp")


SALT_BUCKETS = 64  # tasks that share the copies of one key in a stream


def dedup(df: DataFrame, keys: Sequence[str] = KEYS, watermark: str | None = None, time_col: str = "timestamp",
          order_by: Sequence[str] | None = ("offset",), emit: str = "immediately") -> DataFrame:
    """One row per key. Rows with a null in a key part are different events as
    far as anyone can tell, and all pass through.

    Batch: the first delivered copy (lowest ``order_by``, then the lowest other
    columns), as a partial aggregate, so a key with millions of copies
    collapses map-side to one row per task before the shuffle.

    Stream (``watermark`` set; ``time_col`` must be one of ``keys``):
    * ``emit="immediately"`` (default): a unique event is emitted in the batch
      in which it first arrives, so none is withheld at the end of the input.
      Two ``dropDuplicatesWithinWatermark`` in a row, first on key and salt
      (the input task's number), then on the key: the copies of a hot key, equal
      ones too, are spread over ``SALT_BUCKETS`` tasks and only one per salt
      goes on. The copy kept is any one of them.
    * ``emit="on_watermark"``: the batch aggregate as a stateful one; the first
      delivered copy is emitted once the watermark passes its time (so the last
      ones stay in state until later events come).
    """
    if emit not in ("immediately", "on_watermark"):
        raise ValueError("emit must be 'immediately' or 'on_watermark'")
    order = [c for c in (order_by or ()) if c in df.columns]
    rest = [c for c in df.columns if c not in keys]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    if watermark:
        if time_col not in keys:
            raise ValueError(f"{time_col} must be a key of a stream's de-dup")
        df = df.withWatermark(time_col, watermark)
    whole = df.filter(~no_key)
    if watermark and emit == "immediately":
        salt = F.pmod(F.spark_partition_id(), F.lit(SALT_BUCKETS))  # equal copies differ in where they arrive
        once = whole.withColumn("_salt", salt).dropDuplicatesWithinWatermark([*keys, "_salt"])
        picked = once.drop("_salt").dropDuplicatesWithinWatermark(list(keys))
    elif not rest:
        picked = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    else:
        # maps cannot be ordered; they follow the row that is picked
        sortable = [c for c in rest if c not in order and not df.schema[c].dataType.simpleString().startswith("map<")]
        first = F.min_by(F.struct(*rest), F.struct(*order, *sortable)) if order or sortable else F.first(F.struct(*rest))
        picked = whole.groupBy(*keys).agg(first.alias("_row"))
        picked = picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    return picked.select(*df.columns).unionByName(df.filter(no_key))
