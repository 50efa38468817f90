"""Document fingerprints by MinHash.

Shingles of ``SHINGLE`` words are hashed to 64 bits; each of ``LANES``
multiply-shift functions (universal hashing) permutes them, and a document
keeps the minimum of each, 16 bits per lane. The share of equal lanes of two
fingerprints estimates the Jaccard similarity of the shingle sets. All of it is
vectorised in numpy over a slice of a batch.

``near_duplicates`` finds the pairs: lanes are cut into bands, fingerprints
that share a band are joined in Spark, and the Jaccard similarity of their
whole shingle sets is verified. ``edited_fingerprints`` fingerprints each
document next to an edited copy whose tail comes from the following document.

Scale: the neighbour in id order comes from one range partitioning: rows are
read in order within their partition, and only the last row of each partition
meets the first row of the next one in a second, tiny job.

Defined cases: null texts are empty; fewer words than a shingle make one
shingle of all words; texts without words have the fingerprint of all ones,
equal to each other. In id order, rows without an id come first and rows with
equal ids follow their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import connected_components, map_arrow, quoted, stage
from eventlake.llm.text import MIX_A, MIX_B, SLICE_BYTES, WORD_BASE, as_bytes, mix64, range_hash, slices, word_hashes

SHINGLE = 5
LANES = 128
BAND = 6  # lanes in a band: 21 bands find a pair at similarity 0.8 with probability 0.998
SEED = 11
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def coefficients(lanes: int = LANES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng(seed)
    a = rnd.integers(0, 2 ** 63, lanes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rnd.integers(0, 2 ** 63, lanes, dtype=np.uint64) * np.uint64(2)


def shingle_hashes(raw: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle and the index of each row's first one."""
    hashes, rows = word_hashes(raw, offsets)
    n = np.diff(rows)
    count = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    first = np.r_[0, np.cumsum(count)]
    row = np.repeat(np.arange(len(n)), count)
    start = rows[row] + np.arange(first[-1]) - first[row]
    length = np.minimum(n[row], shingle)
    out = range_hash(hashes, start, start + length, WORD_BASE)
    return mix64(out ^ (length.astype(np.uint64) * MIX_B)), first


def signatures(raw: np.ndarray, offsets: np.ndarray, lanes: int = LANES, shingle: int = SHINGLE,
               seed: int = SEED) -> np.ndarray:
    """(rows, lanes) 16-bit minima."""
    x, first = shingle_hashes(raw, offsets, shingle)
    out = np.full((len(first) - 1, lanes), EMPTY, np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        starts = first[some]
        y = np.empty_like(x)
        for i, (a, b) in enumerate(zip(*coefficients(lanes, seed))):
            np.multiply(x, a, out=y)
            y += b
            out[some, i] = np.minimum.reduceat(y, starts)
    # the minimum's upper bits are small by being the minimum; mix before cutting to 16 bits
    return np.where(out == EMPTY, EMPTY, mix64(out)).astype(np.uint16)


def of_texts(texts: list[bytes], **kw) -> np.ndarray:
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    return signatures(np.frombuffer(b"".join(texts), np.uint8), offsets, **kw)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many first ones of ``following``, or all."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _compared(texts: list[str], following: list[str]) -> list[pa.Array]:
    """n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    changed = [edited(t, f).encode("utf-8", "replace") for t, f in zip(texts, following)]
    own = of_texts([t.encode("utf-8", "replace") for t in texts])
    new = of_texts(changed)
    after = of_texts([f.encode("utf-8", "replace") for f in following])
    return _result([len(t) for t in texts], changed, own, new, after)


def _result(lengths, changed, own, new, after) -> list[pa.Array]:
    return [pa.array(lengths, pa.int64()), pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
            pa.array([s.astype(">u2").tobytes() for s in own], pa.binary()),
            pa.array([s.astype(">u2").tobytes() for s in new], pa.binary()),
            pa.array(likeness(own, new)), pa.array(likeness(own, after))]


RESULT = ("n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, "
          "near_next double")
NAMES = [f.split()[0] for f in RESULT.split(", ")]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, doc_id, text) in order -> results; the first and the last
    row of the partition also come with their text (kind 1 and 2)."""
    part = doc_id = schema = None
    text: str | None = None  # the row whose follower has not come yet

    def edge(kind, p, i, t):
        empty = [pa.nulls(1, f) for f in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(),
                                          pa.float64())]
        return pa.RecordBatch.from_arrays([p, i, pa.array([t], pa.string()), pa.array([kind], pa.int32()), *empty],
                                          ["part", "doc_id", "text", "kind", *NAMES])

    for batch in batches:
        for rows in slices(batch, "text", SLICE_BYTES):
            texts = [t or "" for t in rows.column(2).cast(pa.string()).to_pylist()]
            if text is None:
                yield edge(1, rows.column(0).slice(0, 1), rows.column(1).slice(0, 1), texts[0])
                parts, ids = rows.column(0), rows.column(1)
            else:
                texts = [text, *texts]
                parts, ids = pa.concat_arrays([part, rows.column(0)]), pa.concat_arrays([doc_id, rows.column(1)])
            n = len(texts) - 1
            if n:
                changed = [edited(a, b).encode("utf-8", "replace") for a, b in zip(texts, texts[1:])]
                own = of_texts([t.encode("utf-8", "replace") for t in texts])
                cols = _result([len(t) for t in texts[:n]], changed, own[:n], of_texts(changed), own[1:])
                yield pa.RecordBatch.from_arrays(
                    [parts.slice(0, n), ids.slice(0, n), pa.nulls(n, pa.string()), pa.array(np.zeros(n, np.int32)),
                     *cols], ["part", "doc_id", "text", "kind", *NAMES])
            text, part, doc_id = texts[-1], parts.slice(n, 1), ids.slice(n, 1)
    if text is not None:
        yield edge(2, part, doc_id, text)


def edited_fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_chars, and the fingerprints of the text and of its
    edited copy (binary), with the likeness to the copy and to the next text."""
    narrow = docs.select(quoted(doc_id).alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    # F.xxhash64 of the text spreads rows that share an id
    ordered = (narrow.repartitionByRange("doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
               .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    rows = stage(map_arrow(ordered, _in_order, f"part int, doc_id {id_type}, text string, kind int, {RESULT}"),
                 "fingerprint_rows")
    heads = rows.where("kind = 1").select("part", F.col("text").alias("following"))
    tails = rows.where("kind = 2").select("part", "doc_id", "text")
    # one row per partition: which partition's head follows its tail
    order = Window.orderBy("part")
    links = heads.select("part").withColumn("next", F.coalesce(
        F.lead("part").over(order), F.min("part").over(Window.partitionBy(F.lit(1)))))
    met = (tails.join(links, "part").drop("part")
           .join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "following"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                cols = _compared(part.column(1).to_pylist(), part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", *NAMES])

    last = map_arrow(met, compare, f"doc_id {id_type}, {RESULT}")
    return rows.where("kind = 0").select("doc_id", *NAMES).unionByName(last)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    from eventlake.llm.shared import append_columns

    def compute(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([s.astype(">u2").tobytes() for s in signatures(*as_bytes(texts))], pa.binary())]

    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return append_columns(narrow, "text", compute, "fingerprint binary").drop("text")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id) of every row with an id: class_id is the smallest id
    that verified links reach. Equal shingle sets are one class first (by 64
    bits of a hash), every class is judged by a text of its own; within a band
    every member is verified against the band's smallest member, and members
    that fail are banded among themselves again, until none is left."""
    from eventlake.llm.shared import append_columns

    def compute(col: pa.Array) -> list[pa.Array]:
        raw, offsets = as_bytes(col)
        x, first = shingle_hashes(raw, offsets)
        sets = [hashlib.md5(np.unique(x[a:b]).tobytes()).digest()[:8] for a, b in zip(first, first[1:])]
        return [pa.array(np.frombuffer(b"".join(sets), np.int64)),
                pa.array([s.astype(">u2").tobytes() for s in signatures(raw, offsets)], pa.binary())]

    # a text is known by its id and its digest
    digest = F.unhex(F.md5(F.coalesce(quoted(text), F.lit("")).cast("binary")))
    narrow = (docs.select(quoted(doc_id).alias("doc_id"), digest.alias("digest"), quoted(text).alias("text"))
              .where(F.col("doc_id").isNotNull()))
    rows = stage(append_columns(narrow, "text", compute, "rep long, fingerprint binary").drop("text"), "minhash_rows")
    reps = rows.groupBy("rep").agg(F.min("fingerprint").alias("fingerprint"),
                                   F.min(F.struct("doc_id", "digest")).alias("first"))
    reps = stage(reps.select("rep", "fingerprint", "first.*"), "minhash_classes")
    texts = narrow.join(reps, ["doc_id", "digest"]).groupBy("rep").agg(F.min("text").alias("text"))
    bands = [F.xxhash64(F.lit(i), F.substring("fingerprint", 2 * BAND * i + 1, 2 * BAND))
             for i in range(LANES // BAND)]
    open_ = stage(reps.select("rep", F.explode(F.array(*bands)).alias("band")), "minhash_bands")
    links = None
    while True:
        hub = open_.groupBy("band").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
        pairs = open_.join(hub, "band").where("rep > hub").select("band", "hub", "rep")
        pairs = stage(pairs, "minhash_pairs")
        if pairs.isEmpty():
            break
        judged = stage(_verified(pairs.select("hub", "rep").distinct(), texts, threshold), "minhash_judged")
        near = judged.where("near").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
        links = near if links is None else links.unionByName(near)
        # who is linked to its hub is done in this band only if the others still meet it: keep the rest and the linked
        fails = judged.where("not near").select("hub", "rep")
        left = pairs.join(fails, ["hub", "rep"], "left_semi").select("rep", "band").distinct()
        near_in_band = pairs.join(near.select(F.col("a").alias("hub"), F.col("b").alias("rep")), ["hub", "rep"])
        mixed = left.select("band").distinct()
        open_ = stage(left.unionByName(near_in_band.join(mixed, "band", "left_semi").select("rep", "band")),
                      "minhash_bands")
    firsts = reps.select("rep", F.col("doc_id").alias("first_id"))
    if links is None:
        return rows.join(firsts, "rep").select("doc_id", F.col("first_id").alias("class_id"))
    parts = connected_components(links).select(F.col("node").alias("rep"), "component")
    firsts = firsts.join(parts, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    smallest = firsts.groupBy("component").agg(F.min("first_id").alias("class_id"))
    ids = firsts.join(smallest, "component").select("rep", "class_id")
    return rows.join(ids, "rep").select("doc_id", "class_id")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(hub, rep, near): Jaccard similarity of the whole shingle sets at least ``threshold``."""
    both = (pairs.join(texts.select(F.col("rep").alias("hub"), F.col("text").alias("t1")), "hub")
            .join(texts.select("rep", F.col("text").alias("t2")), "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for a, b in zip(batch.column(2), batch.column(3)):
                sets = [np.unique(shingle_hashes(*as_bytes(pa.array([x.as_py()], pa.string())))[0]) for x in (a, b)]
                common = len(np.intersect1d(*sets, assume_unique=True))
                union = len(sets[0]) + len(sets[1]) - common
                near.append(union == 0 or common / union >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.bool_())],
                                             ["hub", "rep", "near"])

    kind = pairs.schema["hub"].dataType.simpleString()
    return map_arrow(both.select("hub", "rep", "t1", "t2"), run, f"hub {kind}, rep {kind}, near boolean")
