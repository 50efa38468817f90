"""Helpers that several operators share: tables in the shared folder and
connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from eventlake.operators.joins import observed
from eventlake.session import shared_path

# Fixed character classes.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_WORD = r"[^\x20\x09-\x0D]+"  # a word: anything between ASCII white space


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def quoted(name: str) -> Column:
    """A column by its exact name (names may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_prefix(columns: list[str], prefix: str) -> str:
    """``prefix``, lengthened until no column name starts with it in any case:
    internal columns named by it meet none of the caller's."""
    while any(c.lower().startswith(prefix.lower()) for c in columns):
        prefix += "_"
    return prefix


def table_path(df: DataFrame, name: str) -> str:
    return shared_path(df.sparkSession, "llm", name)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, and several readers do not compute it again."""
    path = table_path(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict]:
    """``stage`` with aggregates of the rows observed during the write."""
    obs = Observation(f"{name}_{uuid.uuid4().hex}")
    exprs = {"rows": F.count(F.lit(1)), **counts}
    table = stage(df.observe(obs, *[e.alias(k) for k, e in exprs.items()]), name)
    got = observed(obs)
    return table, {k: got.get(k) or 0 for k in exprs}


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component = smallest node reachable.

    Min-label propagation with pointer jumping: each round a node takes the
    smallest label among its own, its neighbours' and its label's label, so
    long chains halve per round. Every round is one aggregate (partial before
    the shuffle, so a node with very many links is combined early) and ends in
    a table of the shared folder. Self loops are allowed; no edges give no rows.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("nbr"))
    both = stage(both.unionByName(both.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))).distinct(),
                 "links")
    labels, seen = stage_counted(
        both.groupBy("node").agg(F.least(F.min("nbr"), F.col("node")).alias("label")), "labels",
        total=F.sum(F.col("label").cast("decimal(38,0)")))
    while seen["rows"]:
        near = both.join(labels.select(F.col("node").alias("nbr"), "label"), "nbr").select("node", "label")
        jump = (labels.alias("x").join(labels.alias("y"), F.col("x.label") == F.col("y.node"))
                .select(F.col("x.node").alias("node"), F.col("y.label").alias("label")))
        step = labels.unionByName(near).unionByName(jump).groupBy("node").agg(F.min("label").alias("label"))
        labels, now = stage_counted(step, "labels", total=F.sum(F.col("label").cast("decimal(38,0)")))
        if now["total"] == seen["total"]:
            break
        seen = now
    return labels.select("node", F.col("label").alias("component"))


BATCH_ROWS, BATCH_BYTES = 1000, 4_000_000


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded size. Spark's default fills a
    batch with 10 000 rows, which is a lot of whole texts on either side of the
    pipe; a session that has not chosen its own sizes gets smaller ones."""
    conf = df.sparkSession.conf
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            conf.set(f"spark.sql.execution.arrow.{key}", str(value))
    if any("." in c or "`" in c for c in df.columns):  # mapInArrow reads such names as paths into structs
        plain = free_prefix(df.columns, "column_")
        df = df.toDF(*[f"{plain}{i}" if "." in c or "`" in c else c for i, c in enumerate(df.columns)])
    return df.mapInArrow(function, schema)


def append_columns(df: DataFrame, text: str, compute, fields: str) -> DataFrame:
    """``df`` with columns computed from a text column in Python workers.

    ``compute`` takes an Arrow array of texts (a slice of a batch, bounded in
    bytes) and returns one array per field of the DDL string ``fields``. Names
    that exist already are refused.
    """
    from pyspark.sql.types import StructType

    from eventlake.llm.text import slices

    added = StructType.fromDDL(fields)
    clash = set(added.names) & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    at = df.columns.index(text)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                more = compute(part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *added.names])

    return map_arrow(df, run, StructType([*df.schema.fields, *added.fields]))
