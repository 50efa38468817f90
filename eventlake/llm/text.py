"""Vectorised text helpers for functions that run in Python workers (numpy and
pyarrow only). A batch is handled as one byte array with row offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000  # rows are worked on in slices of about this many bytes of text

# Odd multipliers of the hash polynomials and of the finaliser (fixed values).
BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (the splitmix64 one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_A
    x ^= x >> np.uint64(27)
    x = x * MIX_B
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base odd)."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, from one prefix sum."""
    up, down = powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * down[starts]


def as_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a text column; null rows are empty."""
    col = col.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(offsets) else raw[:0], offsets - (offsets[0] if len(offsets) else 0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of ``column`` (one row at least)."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    n = len(col)
    if not n:
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield batch.slice(first, last - first)
        first = last


def runs(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """The slices of all batches, gathered until they hold ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for part in slices(batch, column):
            held.append(part)
            if sum(p.nbytes for p in held) >= limit:
                yield held
                held = []
    if held:
        yield held


def words(raw: np.ndarray, offsets: np.ndarray,
          between: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes outside ASCII white space, or
    outside the bytes marked in the 256 flags ``between``) and the index of each
    row's first word (one more entry than rows)."""
    n = len(raw)
    space = np.ones(n + 2, bool)
    space[1:-1] = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D)) if between is None else between[raw]
    cut = np.zeros(n + 1, bool)  # a row begins here
    cut[offsets] = True
    inside = ~space[1:-1]
    starts = np.flatnonzero(inside & (space[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside & (space[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, block: int = 4 * SLICE_BYTES,
                between: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word and each row's first word. Long inputs are
    hashed in blocks of words, so memory stays near a small multiple of them."""
    starts, ends, rows = words(raw, offsets, between)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + block, side="right")), i + 1)
        lo, hi = starts[i], ends[j - 1]
        h = range_hash(raw[lo:hi].astype(np.uint64) + np.uint64(1), starts[i:j] - lo, ends[i:j] - lo, BASE)
        out[i:j] = mix64(h ^ ((ends[i:j] - starts[i:j]).astype(np.uint64) * WORD_BASE))
        i = j
    return out, rows
