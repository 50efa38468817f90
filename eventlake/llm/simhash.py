"""SimHash near-duplicate groups through a byte-position inverted index.

A fingerprint has 8 bytes. Two fingerprints that differ in at most ``max_bits``
bits agree in at least 8 - max_bits byte positions (the guaranteed minimum), so
the index posts every fingerprint under each choice of that many (position,
byte) entries: a pair meets in the index exactly if it reaches the minimum.
Within a posting list the shared positional bytes of a pair are tallied, pairs
under the minimum dropped and the bit distance verified.

Scale: equal fingerprints are one class before anything is posted. Lists are
read as sorted runs in the tasks of one shuffle; a run of m fingerprints gives
at most m - 1 links (a spanning forest of the verified pairs), never all its
pairs. Runs above ``max_run`` leave the first index and are posted again under
half-byte positions of the bytes that are still open, which is exact as well.

Defined cases: null or wordless texts have fingerprint 0, which links like any
other; fewer words than a shingle make one shingle of all words; repeated rows
and equal texts share a class; rows without an id get a fingerprint and the
component of their class, whose ids they cannot lower (null if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import connected_components, free_prefix, map_arrow, quoted, stage, stage_counted

SEED = 42
MAX_RUN = 20_000


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """SimHash of a UTF-8 text, as a signed 64-bit number."""
    tokens = raw.lower().split()  # on bytes: A-Z only, ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ends = np.cumsum(lengths + 1) - 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[i:j], SEED) for i, j in zip((ends - lengths)[:len(tokens) - shingle + 1].tolist(),
                                                            ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.array(hashes[i:i + 65_536], np.uint64).astype(">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4) -> DataFrame:
    """(doc_id, fp) for every row."""
    id_type = docs.select(quoted(doc_id)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            fps = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return map_arrow(narrow, run, f"doc_id {id_type}, fp bigint")


def byte_choices(keep: int) -> list[int]:
    """64-bit masks of every choice of ``keep`` of the 8 byte positions."""
    return [sum(0xFF << (8 * i) for i in c) for c in combinations(range(8), keep)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Tally the shared positional bytes, keep pairs at the guaranteed minimum, verify the bits."""
    x = a ^ b
    shared = np.zeros(x.shape, np.uint8)
    for i in range(8):
        shared += ((x >> np.uint64(8 * i)) & np.uint64(0xFF)) == 0
    return (shared >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)


def _forest(fps: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Spanning forest of the links among ``fps`` (pairs of values)."""
    left, a, b = fps, [], []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            here = todo.pop()
            hit = _near(left, here, max_bits)
            if hit.any():
                found, left = left[hit], left[~hit]
                a.append(np.full(len(found), here))
                b.append(found)
                todo.extend(found)
    return a, b


def links_in_runs(max_bits: int, max_run: int | None):
    """Function over batches of (key, fp) sorted by key: rows (a, b, key), where key is
    set for fingerprints b of runs that are too long for this index."""

    def of_runs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[starts, len(key)])
        two = starts[sizes == 2]
        hit = _near(fp[two], fp[two + 1], max_bits)
        a, b = [fp[two][hit]], [fp[two + 1][hit]]
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            x, y = _forest(fp[s:s + n], max_bits)
            a += x
            b += y
        return np.concatenate(a), np.concatenate(b)

    def out(a, b, key=None) -> pa.RecordBatch:
        b = b.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(b), pa.int64()) if a is None else pa.array(a.view(np.int64)), pa.array(b),
             pa.nulls(len(b), pa.int64()) if key is None else pa.array(np.full(len(b), key, np.int64))],
            ["a", "b", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(k):
                continue
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            if hot is not None:  # the rest of a run that was too long
                n = int(np.searchsorted(key != hot, True)) if (key != hot).any() else len(key)
                if n:
                    yield out(None, fp[:n], hot)
                key, fp = key[n:], fp[n:]
                if not len(key):
                    continue
                hot = None
            change = np.flatnonzero(key[1:] != key[:-1])
            last = int(change[-1]) + 1 if len(change) else 0
            if last:
                yield out(*of_runs(key[:last], fp[:last]))
                key, fp = key[last:], fp[last:]
            if max_run is not None and len(key) > max_run:
                hot = key[0]
                yield out(None, fp, hot)
                key, fp = key[:0], fp[:0]
        if len(key):
            yield out(*of_runs(key, fp))

    return run


def posted(classes: DataFrame, choices: list[int]) -> DataFrame:
    """(key, fp): every fingerprint under each choice of byte positions. The
    choice's number is in the key's low 7 bits."""
    keys = [F.xxhash64(F.col("fp").bitwiseAND(F.lit(_signed(m)))).bitwiseAND(F.lit(-128)).bitwiseOR(F.lit(i))
            for i, m in enumerate(choices)]
    return classes.select(F.explode(F.array(*keys)).alias("key"), "fp")


def posted_again(hot: DataFrame, choices: list[int], max_bits: int) -> DataFrame:
    """(key, fp) for lists that were too long: each again under every choice of
    half bytes of its open bytes that links must agree in."""
    finer = []
    for i, m in enumerate(choices):
        free = [j for j in range(16) if not m >> (4 * j) & 0xF]
        finer += [(i, _signed(sum(0xF << (4 * j) for j in c)))
                  for c in combinations(free, max(len(free) - max_bits, 1))]
    table = F.broadcast(hot.sparkSession.createDataFrame(finer, "choice int, half bigint"))  # 4900 rows at most
    return (hot.withColumn("choice", F.col("key").bitwiseAND(F.lit(127)).cast("int")).join(table, "choice")
            .select(F.xxhash64("key", "half", F.col("fp").bitwiseAND(F.col("half"))).alias("key"), "fp"))


def _linked(index: DataFrame, max_bits: int, max_run: int | None) -> DataFrame:
    return map_arrow(index.repartition("key").sortWithinPartitions("key"), links_in_runs(max_bits, max_run),
                     "a bigint, b bigint, key bigint")


def links(classes: DataFrame, max_bits: int = 4, max_run: int = MAX_RUN) -> DataFrame:
    """(a, b) fingerprints at most ``max_bits`` bits apart: enough of them to
    connect what the links of all pairs connect. ``classes`` has distinct ``fp``."""
    if not 0 <= max_bits < 8:
        raise ValueError("max_bits: 0 to 7")
    byte_masks = byte_choices(8 - max_bits)
    found, seen = stage_counted(_linked(posted(classes, byte_masks), max_bits, max_run), "simhash_links",
                                hot=F.count("key"))
    pairs = found.where(F.col("key").isNull()).select("a", "b")
    if seen["hot"]:
        hot = found.where(F.col("key").isNotNull()).select("key", F.col("b").alias("fp"))
        again = stage(_linked(posted_again(hot, byte_masks, max_bits), max_bits, None), "simhash_links")
        pairs = pairs.unionByName(again.select("a", "b"))
    return pairs


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
                   max_bits: int = 4, max_run: int = MAX_RUN) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    rows = stage(fingerprints(docs, text, doc_id, shingle), "simhash_rows")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash_classes")
    parts = connected_components(links(classes.select("fp"), max_bits, max_run))
    joined = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    joined = joined.withColumn("component", F.coalesce("component", "fp"))
    smallest = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = joined.join(smallest, "component").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **kw) -> DataFrame:
    """One document of each group: the one with the smallest id, of its texts
    the one with the smallest digest. A row is known by its id and its text, so
    different texts under one id stand for their own groups. Rows without an id
    stay; of rows that share the kept id and text one stays, chosen by a hash of
    all its columns, so reruns agree. Other columns may have any names."""
    digest = F.unhex(F.md5(F.coalesce(quoted(text), F.lit("")).cast("binary")))
    known = F.when(quoted(doc_id).isNotNull(), F.struct(quoted(doc_id).alias("id"), digest.alias("digest")))
    groups = simhash_groups(docs.select(known.alias("doc_id"), quoted(text).alias("text")), **kw)
    keep = groups.where("doc_id = component_id").select("doc_id").distinct()
    own = free_prefix(docs.columns, "simhash_")
    key = keep.select(F.col("doc_id.id").alias(own + "id"), F.col("doc_id.digest").alias(own + "of"))
    kept = docs.withColumn(own + "digest", digest).join(
        key, (quoted(doc_id) == F.col(own + "id")) & (F.col(own + "digest") == F.col(own + "of")), "left_semi")
    hashable = [quoted(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    row = F.struct(*[quoted(c).alias(c) for c in docs.columns])
    kept = kept.groupBy(quoted(doc_id).alias(own + "id"), own + "digest").agg(
        F.min_by(row, F.xxhash64(*hashable)).alias(own + "row"))
    kept = kept.select(*[F.col(own + "row").getField(c).alias(c) for c in docs.columns])
    return kept.unionByName(docs.where(quoted(doc_id).isNull()))
