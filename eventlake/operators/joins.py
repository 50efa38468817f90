"""Joins of event rows with per-group statistics.

The statistics side has one row per group (device type x day), which is tiny
next to the events, so broadcasting it avoids shuffling the events and avoids
hot groups: a day of one type may hold a third of all rows, and a shuffle join
on (type, day) would put that third into one task. The broadcast is only taken
behind a measured bound: the small side is written once as a table in the
shared checkpoint folder (it has to be computed anyway) with its rows counted
by an observation of that write, and read back; above the bound a shuffle join is used,
with AQE skew handling splitting hot keys. The written table cuts the lineage:
losing an executor later does not re-run the pass over the events.
"""

from __future__ import annotations

from collections.abc import Sequence

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventlake.session import shared_path

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 200_000_000  # as text; what an executor is ready to hold


def observed(o: Observation) -> dict:
    """An observation's values; none where adaptive execution found the plan
    empty and dropped the observed node with it."""
    try:
        return dict(o.get)
    except Exception as e:
        if isinstance(e, AssertionError) or "java.lang.AssertionError" in str(e):
            return {}
        raise


def _written(small: DataFrame, name: str, **measures) -> tuple[DataFrame, dict]:
    spark = small.sparkSession
    path = shared_path(spark, "tables", name)
    obs = Observation(f"{name}_{uuid.uuid4().hex}")
    seen = [F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in measures.items()]]
    small.observe(obs, *seen).write.mode("overwrite").parquet(path)
    return spark.read.schema(small.schema).parquet(path), observed(obs)


def materialize_measured(small: DataFrame, name: str, **measures) -> tuple[DataFrame, dict]:
    """``materialize`` with further aggregates of the rows, observed by the write."""
    table, seen = _written(small, name, **measures)
    return table, {k: seen.get(k) or 0 for k in ("rows", *measures)}


def materialize(small: DataFrame, name: str = "small") -> tuple[DataFrame, int]:
    """Write ``small`` to the shared folder; return it read back and its row
    count (observed during the write, so no second job)."""
    table, seen = _written(small, name)
    return table, int(seen.get("rows") or 0)


def bounded_side(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, name: str = "small",
                 max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """Materialise ``small`` and report whether its measured rows and bytes
    (as JSON text: keys may be of any length) allow a broadcast."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in small.columns]))))
    table, seen = _written(small, name, bytes=size)
    return table, int(seen.get("rows") or 0) <= max_rows and int(seen.get("bytes") or 0) <= max_bytes


def null_safe_join(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner",
                   broadcast: bool = False) -> DataFrame:
    """``df`` joined with ``other`` on ``keys``, null keys being equal to each
    other. The result has ``df``'s columns, then ``other``'s besides the keys."""
    taken = {*df.columns, *other.columns}
    right = {}
    for k in keys:
        name = f"_{k}_other"
        while name in taken:
            name = "_" + name
        taken.add(name)
        right[k] = name
    other = other.select(*[F.col(f"`{c}`").alias(right.get(c, c)) for c in other.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"`{right[k]}`"))
    joined = df.join(F.broadcast(other) if broadcast else other, on, how)
    return joined.drop(*right.values())


def join_group_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "inner",
                     max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``df`` joined with per-group ``stats`` on ``keys`` (a null key is a group
    like any other); broadcast when the measured size allows it, otherwise a
    shuffle join."""
    stats, small_enough = bounded_side(stats, max_rows, "group_stats")
    return null_safe_join(df, stats, keys, how, small_enough)
