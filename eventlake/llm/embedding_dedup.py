"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised, so cosine >= c means a Euclidean distance of at most
sqrt(2 - 2c). Each of ``tables`` hash tables concatenates ``projections``
quantised Gaussian projections floor((v.g + shift) / width); Gaussians are
2-stable, so near vectors share a bucket of some table with known probability.
Pairs that share a bucket are verified by their exact cosine in double
precision and counted once: in the first table in which they meet.

Recall: for a pair at cosine c one projection collides with probability
p(sqrt(2 - 2c)); ``expected_recall`` gives 1 - (1 - p^projections)^tables, and
the defaults give 0.989 at cosine 0.9 and 0.9999 at 0.95.

Scale: equal vectors are one class (their links follow from the class sizes).
A bucket is compared inside the tasks of one shuffle in blocks of at most
``BLOCK`` vectors: a larger bucket is cut into blocks that are compared pair by
pair, each in its own group, so no group grows with the bucket and no pairs are
ever listed: a block gives a link count per vector and at most as many edges as
it has vectors (a spanning forest of its links).

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors of another length than their pair, link with nothing;
each is its own component. Repeated ids are joined by their rows' vectors: a
row's links count other rows. Rows without an id get null components but count
as links of others. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import connected_components, map_arrow, quoted, stage

TABLES = 30
PROJECTIONS = 10
WIDTH = 2.0
BLOCK = 1024
SEED = 20_240_501


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised Gaussian projection agrees at ``distance``."""
    if distance == 0:
        return 1.0
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def expected_recall(cosine: float, tables: int = TABLES, projections: int = PROJECTIONS,
                    width: float = WIDTH) -> float:
    p = collision(math.sqrt(max(2 - 2 * cosine, 0.0)), width)
    return 1 - (1 - p ** projections) ** tables


def usable(vector: Column) -> Column:
    """A vector that can link: not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(flat: np.ndarray, dim: int) -> np.ndarray:
    v = flat.astype(np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # keeps squares finite
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def bucket_keys(vectors: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """(vectors, tables) 32-bit bucket keys."""
    rnd = np.random.default_rng([seed, vectors.shape[1]])
    directions = rnd.standard_normal((vectors.shape[1], tables * projections))
    shift = rnd.uniform(0, width, tables * projections)
    cells = np.floor((vectors @ directions + shift) / width).astype(np.int64).view(np.uint64)
    odd = rnd.integers(0, 2 ** 63, (tables, projections), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    keys = (cells.reshape(-1, tables, projections) * odd).sum(axis=2, dtype=np.uint64)
    keys ^= keys >> np.uint64(29)
    return (keys * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def hashed(classes: DataFrame, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """(cls, size, vector, keys) with the bucket key of every table."""
    vector_type = classes.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                keys = bucket_keys(unit_rows(flat, int(dim)), tables, projections, width, seed)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), lists.take(at),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32)),
                                              pa.array(keys.ravel()))], ["cls", "size", "vector", "keys"])

    return map_arrow(classes, run, f"cls bigint, size bigint, vector {vector_type}, keys array<int>")


def _forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of an adjacency matrix."""
    left, edges = np.ones(len(adjacent), bool), []
    for root in range(len(adjacent)):
        if not left[root]:
            continue
        left[root], todo = False, [root]
        while todo:
            i = todo.pop()
            found = np.flatnonzero(adjacent[i] & left)
            left[found] = False
            edges += [(i, int(j)) for j in found]
            todo += found.tolist()
    return edges


def _compare(table: int, sizes: np.ndarray, units: np.ndarray, keys: np.ndarray, side: np.ndarray,
             cosine: float):
    """Link counts and forest edges of one block (side 0) or of the pairs across two (sides 1 and 2)."""
    near = units @ units.T >= cosine
    np.fill_diagonal(near, False)
    if side[0]:
        near &= side[:, None] != side[None, :]
    for t in range(table):
        if not near.any():
            break
        near &= keys[:, t, None] != keys[None, :, t]  # met before: counted there
    if not near.any():
        return np.zeros(len(near), np.int64), []
    return near @ sizes, _forest(near)


def block_links(tables: int, cosine: float):
    """Function over sorted (table, key, part, side, cls, size, vector, keys)
    rows: per group of (table, key, part) the links of each class and edges."""

    def out(a, b, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())],
                                          ["cls", "other", "links"])

    def of_group(table, rows: pa.RecordBatch):
        a, b, n = [], [], []
        lists = rows.column("vector")
        dims = np.diff(lists.offsets.to_numpy())
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            if len(at) < 2:
                continue
            part = rows.take(pa.array(at))
            ids = part.column("cls").to_pylist()
            units = unit_rows(part.column("vector").flatten().to_numpy(zero_copy_only=False), int(dim))
            keys = part.column("keys").flatten().to_numpy(zero_copy_only=False).reshape(len(at), tables)
            counts, edges = _compare(table, part.column("size").to_numpy(zero_copy_only=False), units, keys,
                                     part.column("side").to_numpy(zero_copy_only=False), cosine)
            for i in np.flatnonzero(counts):
                a.append(ids[i])
                b.append(None)
                n.append(int(counts[i]))
            for i, j in edges:
                a.append(ids[i])
                b.append(ids[j])
                n.append(0)
        return out(a, b, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.concat_batches([*held, batch]) if held else batch
            key = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("table", "key", "part")]
            new = np.zeros(len(rows), bool)
            for k in key:
                new[1:] |= k[1:] != k[:-1]
            cuts = [0, *np.flatnonzero(new).tolist()]
            for i, j in zip(cuts, cuts[1:]):
                if j - i > 1:
                    yield of_group(int(key[0][i]), rows.slice(i, j - i))
            held = [rows.slice(cuts[-1])]
        if held and len(held[0]) > 1:
            yield of_group(int(pc.min(held[0].column("table")).as_py()), held[0])

    return run


def class_links(classes: DataFrame, cosine: float = 0.9, tables: int = TABLES, projections: int = PROJECTIONS,
                width: float = WIDTH, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(cls, other, links): link counts (other null) and edges between classes
    of (cls, size, vector); vectors differ between classes."""
    rows = stage(hashed(classes, tables, projections, width, seed), "embedding_keys")
    posted = rows.select("cls", F.posexplode("keys").alias("table", "key"))
    buckets = posted.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = rows.select("*", F.posexplode("keys").alias("table", "key")).join(buckets, ["table", "key"])
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("cls", "table"), F.col("parts")).cast("int")
    met = met.withColumn("parts", parts).withColumn("own", own)
    # a block meets itself (side 0) and every other block once (side 1 the lower, side 2 the higher block)
    groups = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(
        (F.least(i, F.col("own")) * F.col("parts") + F.greatest(i, F.col("own"))).alias("part"),
        F.when(i == F.col("own"), 0).when(i < F.col("own"), 2).otherwise(1).alias("side")))
    met = met.select("table", "key", "cls", "size", "vector", "keys", F.explode(groups).alias("g"))
    met = met.select("table", "key", F.col("g.part").alias("part"), F.col("g.side").alias("side"), "cls", "size",
                     "vector", "keys")
    met = met.repartition("table", "key", "part").sortWithinPartitions("table", "key", "part")
    return map_arrow(met, block_links(tables, cosine), "cls bigint, other bigint, links bigint")


def embedding_groups(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", cosine: float = 0.9,
                     **kw) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    kind = vectors.select(quoted(vec_id)).schema[0].dataType
    given = vectors.select(quoted(vector)).schema[0].dataType.simpleString()
    vector_type = given if given in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(quoted(vec_id).cast("long").alias("vec_id"), quoted(vector).cast(vector_type).alias("vector"))
    rows = rows.withColumn("vector", F.when(usable(F.col("vector")), F.col("vector")))
    # adding 0.0 makes -0.0 and 0.0 one value
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)).cast(vector_type))
    rows = rows.withColumn("h", F.xxhash64("vector"))
    rows = stage(rows, "embedding_rows")
    classes = (rows.where(F.col("vector").isNotNull()).groupBy("h", "vector")
               .agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("first_id")))
    classes = stage(classes.withColumn("cls", F.monotonically_increasing_id()), "embedding_classes")
    found = stage(class_links(classes.select("cls", "size", "vector"), cosine, **kw), "embedding_links")
    counts = found.where(F.col("other").isNull()).groupBy("cls").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where(F.col("other").isNotNull()), "cls", "other")
    info = (classes.join(counts, "cls", "left").join(parts.withColumnRenamed("node", "cls"), "cls", "left")
            .withColumn("component", F.coalesce("component", "cls")))
    smallest = info.groupBy("component").agg(F.min("first_id").alias("component_id"))
    info = info.join(smallest, "component").select(
        "h", "vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    out = rows.join(info, ["h", "vector"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select(F.col("vec_id").cast(kind), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.cast("long").alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
