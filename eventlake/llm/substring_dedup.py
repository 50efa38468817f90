"""Substring dedup over a compacted De Bruijn graph of token k-mers.

The edges of the graph are the windows of ``window`` consecutive words (token
k-mers with k = window); an edge follows another where they overlap in all but
one word. The graph is compacted the way genome assemblers do it at scale:

1. Every window names its anchor, the shorter k-mer (``ANCHOR`` words) with the
   smallest hash in it. Consecutive windows of a document with the same anchor
   are one run, a path without branches within that document. A run is one row
   (document, start, anchor hash, hash of all its words), so a document gives
   about one row per ``window - ANCHOR`` / 2 words, not one per window.
2. Equal windows have equal anchors, so anchors of a single document leave the
   graph at once. Of the rest, runs of equal words are one compacted path; an
   anchor with one such path does not branch, and the path's smallest document
   is the source of every occurrence (a join on anchor and words).
3. At branching anchors the paths are cut into their single edges again: one
   representative of each path is read at its source coordinates, its windows
   are hashed there, and the smallest document of each window is found by a
   partial aggregate and joined back to the paths.
4. Occurrences whose window has a smaller document become marks, collected per
   document, and the words they cover are removed.

Equality is decided by the anchor's hash together with the 64-bit hash of all
words of the path or window, both taken from the words at the coordinates.

Scale: the only tables of the corpus' size are the runs (a few per cent of the
words) and the texts; groups are combined before they are shuffled, the joins
are shuffle joins whose hot keys adaptive execution splits, and only a
document's own marks ever meet in one row.

Defined cases: null texts have no words; texts under ``window`` words lose
nothing; repeated rows share an id, so neither is smaller and both stay; rows
without an id neither lose words nor are a source; other columns may have any
names (``dedup_texts`` names its own apart from them).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import free_prefix, map_arrow, quoted, stage, stage_counted
from eventlake.llm.text import BASE, MIX_A, MIX_B, WORD_BASE, as_bytes, mix64, range_hash, slices, word_hashes

WINDOW = 50
ANCHOR = 16
CHUNK = 1 << 20  # windows worked on at a time
HOT_SHARE = 1000  # an anchor with more than one in so many runs is hot: fewer than HOT_SHARE are

# A run in one number: start (from bit 28), number of windows, place of the
# anchor in the first window, 16 bits of the text's checksum.
START_BIT, COUNT_BIT, PLACE_BIT = 28, 22, 16


def checksum(raw) -> int:
    return zlib.crc32(raw) & 0xFFFF


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first smallest value of every ``width`` consecutive ones."""
    best, at, size = values, np.arange(len(values)), 1

    def merge(shift: int):
        a, b = best[:-shift], best[shift:]
        left = a <= b
        return np.where(left, a, b), np.where(left, at[:-shift], at[shift:])

    while size * 2 <= width:
        best, at = merge(size)
        size *= 2
    if size < width:
        best, at = merge(width - size)
    return at


def runs_of(hashes: np.ndarray, rows: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """(row, start, windows, place, anchor hash, words hash) of the runs in rows of word hashes."""
    parts = []
    width = window - anchor + 1
    for at in range(0, max(len(hashes) - window + 1, 0), CHUNK):
        h = hashes[at:at + CHUNK + window - 1]
        n = len(h) - window + 1
        k = np.arange(len(h) - anchor + 1)
        kmers = mix64(range_hash(h, k, k + anchor, WORD_BASE))
        p = np.arange(n)
        row = np.searchsorted(rows, p + at, side="right") - 1
        ok = p + at + window <= rows[row + 1]
        p, row = p[ok], row[ok]
        if not len(p):
            continue
        q = leftmost_minimum(kmers, width)[p]
        first = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (p[1:] != p[:-1] + 1)])
        count = np.diff(np.r_[first, len(p)])
        lo, place = p[first], q[first] - p[first]
        words = range_hash(h, lo, lo + count + window - 1, BASE)
        words = mix64(words ^ (place.astype(np.uint64) * MIX_A) ^ (count.astype(np.uint64) * MIX_B))
        parts.append((row[first], lo + at - rows[row[first]], count, place, kmers[q[first]], words))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def runs(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, run, a, s) of (doc_id, text) rows; ``a`` hashes the anchor, ``s`` all words of the run."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, offsets = as_bytes(part.column(1))
                row, start, count, place, a, s = runs_of(*word_hashes(raw, offsets), window, anchor)
                sums = np.array([checksum(raw[i:j].tobytes()) for i, j in zip(offsets, offsets[1:])], np.int64)
                packed = start << START_BIT | count << COUNT_BIT | place << PLACE_BIT | sums[row]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(packed), pa.array(a.view(np.int64)),
                     pa.array(s.view(np.int64))], ["doc_id", "run", "a", "s"])

    return map_arrow(docs, run, f"doc_id {id_type}, run bigint, a bigint, s bigint")


def edges_at(docs: DataFrame, asked: DataFrame, window: int = WINDOW) -> DataFrame:
    """(a, s, j, w, source): the hash of each window of the asked paths, read at
    their source coordinates. ``asked`` has a list of (run, a, s) per doc_id."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, offsets = as_bytes(part.column(1))
                hashes, rows = word_hashes(raw, offsets)
                asks = part.column(2)
                row = np.repeat(np.arange(len(part)), np.diff(asks.offsets.to_numpy()))
                flat = asks.flatten()
                packed, a, s = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                sums = np.array([checksum(raw[i:j].tobytes()) for i, j in zip(offsets, offsets[1:])], np.int64)
                ok = (packed & 0xFFFF) == sums[row]  # rows that share an id may differ in text
                row, packed, a, s = row[ok], packed[ok], a[ok], s[ok]
                count = packed >> COUNT_BIT & 63
                each = np.repeat(np.arange(len(packed)), count)
                j = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                first = rows[row[each]] + (packed[each] >> START_BIT) + j
                place = (packed[each] >> PLACE_BIT & 63) - j
                w = mix64(range_hash(hashes, first, first + window, BASE) ^ ((place + 64).astype(np.uint64) * MIX_B))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[each]), pa.array(s[each]), pa.array(j.astype(np.int32)), pa.array(w.view(np.int64)),
                     part.column(0).take(pa.array(row[each]))], ["a", "s", "j", "w", "source"])

    return map_arrow(docs.join(asked, "doc_id").select("doc_id", "text", "asks"), run,
                     f"a bigint, s bigint, j int, w bigint, source {id_type}")


def marks(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, marks): the runs of each document with a bit mask of the windows
    that also start in a document with a smaller id."""
    if not 0 < anchor <= window or window - anchor >= 63:
        raise ValueError("anchor: at most window words, and fewer than 63 under it")
    docs = docs.where(F.col("doc_id").isNotNull())
    all_runs, seen = stage_counted(runs(docs, window, anchor), "substring_runs")
    shared = stage(all_runs.groupBy("a").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                             F.count(F.lit(1)).alias("n"))
                   .where("lo < hi").select("a", "n"), "substring_shared")
    # runs of hot anchors stay where they are, the others meet their anchors by a shuffle
    is_hot = F.col("n") > F.lit(seen["rows"] / HOT_SHARE)
    hot = F.broadcast(shared.where(is_hot).select("a"))  # fewer than HOT_SHARE rows
    repeats = all_runs.join(hot, "a", "left_anti").join(shared.where(~is_hot).select("a"), "a", "left_semi")
    repeats = stage(repeats.unionByName(all_runs.join(hot, "a", "left_semi")), "substring_repeats")
    first = F.min(F.struct("doc_id", "run"))
    paths = stage(repeats.groupBy("a", "s").agg(first.alias("first"), F.max("doc_id").alias("hi"))
                  .select("a", "s", F.col("first.doc_id").alias("source"), F.col("first.run").alias("run"), "hi"),
                  "substring_paths")
    branching = paths.groupBy("a").agg(F.count(F.lit(1)).alias("paths")).where("paths > 1").select("a")
    # staged, so that later joins on anchor and words are not dealt by a (hot) anchor alone
    branched = stage(paths.join(branching, "a", "left_semi"), "substring_branched")
    plain = paths.join(branching, "a", "left_anti").where("source < hi")
    asked = (branched.groupBy(F.col("source").alias("doc_id"))
             .agg(F.collect_list(F.struct("run", "a", "s")).alias("asks")))
    edges = stage(edges_at(docs, asked, window), "substring_edges")
    least = edges.groupBy("a", "w").agg(F.min("source").alias("least"))
    cut = (edges.join(least, ["a", "w"]).join(branched.select("a", "s", "hi"), ["a", "s"])
           .where("least < source or source < hi")
           .groupBy("a", "s").agg(F.collect_list(F.struct("j", "least")).alias("edges")))
    sources = plain.select("a", "s", "source", F.lit(None).cast(cut.schema["edges"].dataType).alias("edges"))
    sources = sources.unionByName(cut.select("a", "s", F.lit(None).cast(paths.schema["source"].dataType)
                                             .alias("source"), "edges"))
    one = F.lit(1).cast("bigint")
    all_windows = F.expr(f"shiftleft(1L, cast(shiftright(run, {COUNT_BIT}) & 63 as int)) - 1")
    by_edge = F.aggregate("edges", F.lit(0).cast("bigint"), lambda m, e: F.when(
        e["least"] < F.col("doc_id"), m.bitwiseOR(F.call_function("shiftleft", one, e["j"]))).otherwise(m))
    mask = F.when(F.col("edges").isNull(), F.when(F.col("source") < F.col("doc_id"), all_windows)).otherwise(by_edge)
    found = repeats.join(sources, ["a", "s"]).withColumn("mask", mask).where("mask != 0")
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("run", "mask")).alias("marks"))


def covered(n_words: int, packed: np.ndarray, mask: np.ndarray, window: int) -> np.ndarray:
    """Which of a document's words lie in a marked window."""
    steps = np.zeros(n_words + 1, np.int64)
    start = packed >> START_BIT
    for j in range(63):
        at = start[(mask >> j & 1).astype(bool)] + j
        np.add.at(steps, at, 1)
        np.add.at(steps, at + window, -1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                   anchor: int = ANCHOR, prefix: str = "dedup_") -> DataFrame:
    """``docs`` with ``<prefix>n_words``, ``<prefix>n_removed`` and ``<prefix>kept``
    (the kept words joined by one space)."""
    names = [prefix + n for n in ("n_words", "n_removed", "kept")]
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}; choose another prefix")
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    own = free_prefix(docs.columns, "marks_")
    found = marks(narrow, window, anchor).select(F.col("doc_id").alias(own + "id"), F.col("marks").alias(own + "of"))
    joined = docs.join(found, quoted(doc_id) == F.col(own + "id"), "left").drop(own + "id")
    at, n = docs.columns.index(text), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.schema.names[at]):
                total, gone, kept = [], [], []
                for t, m in zip(part.column(at).cast(pa.large_binary()), part.column(n)):
                    raw = t.as_py() or b""
                    words = raw.split()
                    total.append(len(words))
                    removed = 0
                    if m.is_valid:
                        packed = m.values.field(0).to_numpy(zero_copy_only=False)
                        mask = m.values.field(1).to_numpy(zero_copy_only=False)
                        own = (packed & 0xFFFF) == checksum(raw)
                        out = covered(len(words), packed[own], mask[own], window)
                        removed = int(out.sum())
                        words = [w for w, x in zip(words, out.tolist()) if not x]
                    gone.append(removed)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], [*part.schema.names[:n], *names])

    from pyspark.sql.types import StructType

    schema = StructType([*docs.schema.fields,
                         *StructType.fromDDL(f"`{names[0]}` long, `{names[1]}` long, `{names[2]}` string").fields])
    return map_arrow(joined, run, schema)


def dedup_texts(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", **kw) -> DataFrame:
    """``docs`` without the repeated words. Texts that lose none stay as they
    are; ``n_chars``, if there, follows the text."""
    prefix = kw.pop("prefix", None) or free_prefix(docs.columns, "dedup_")
    out = remove_repeats(docs, text, prefix=prefix, **kw)
    changed = quoted(prefix + "n_removed") > 0
    new = F.when(changed, quoted(prefix + "kept")).otherwise(quoted(text))
    cols = []
    for f in docs.schema.fields:
        if f.name == text:
            cols.append(new.alias(text))
        elif f.name == n_chars:
            cols.append(F.when(changed, F.char_length(new)).otherwise(quoted(n_chars)).cast(f.dataType).alias(n_chars))
        else:
            cols.append(quoted(f.name))
    return out.select(*cols)
