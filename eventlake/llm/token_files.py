"""Token files: concatenated token ids with Elias-Fano document boundaries.

Format. A file set is a folder of Parquet files, one per shard, whose rows are
blocks of about ``BLOCK_TOKENS`` ids; Parquet only carries the binary payloads,
so that any store Spark can write works, tasks commit whole files, and readers
fetch the blocks they need. A block has

* ``ids``      the ids of its documents, one after another, little-endian,
               ``width`` bytes each (2 if the vocabulary allows, else 4);
* ``ends``     Elias-Fano list of where each document's ids end;
* ``doc_ids``  Elias-Fano list of doc_id - ``base``, after ``n_null`` rows
               without an id;
* ``shard_doc``, ``shard_token``  documents and ids before it in its shard.

Shards are in ascending order of doc_id, and so are the blocks and documents in
them. The ids before a shard come from the shards' totals, one small row each:
no table holds a 64-bit offset per document. An Elias-Fano list of n values
below u takes about 2 + log2(u / n) bits per value and answers select(i) from
samples of its upper bits.

Defined cases: null texts have no ids but the end id; rows without a doc_id
come first; rows that share an id follow each other; an empty table gives an
empty file set. doc_ids are whole numbers.
"""

from __future__ import annotations

import os
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.bpe import MAY_BE_SPACE, ONE_BYTE_SPACE, coded_chunks, gather
from eventlake.llm.shared import map_arrow, quoted, table_path
from eventlake.llm.text import runs
from eventlake.operators.joins import bounded_side

BLOCK_TOKENS = 1 << 20
END_ID = 0
CACHE = 500_000  # chunks of text remembered by a Python worker, twice at most (about 200 bytes each)
CODED_BYTES = 8_000_000  # text whose distinct chunks are looked up together
JOINT, CALL = 200, 50  # chunks of one text given to the library, texts of one call
SAMPLE = 64  # every so many values the place of the upper bit is kept
MAX_SHARDS_TO_BROADCAST = 1_000_000

BLOCK = ("shard int, block int, shard_doc bigint, shard_token bigint, n_docs int, n_tokens bigint, n_null int, "
         "base bigint, width int, ids binary, ends binary, doc_ids binary")


class EliasFano:
    """A non-decreasing list of numbers >= 0 in near-minimal space.

    Bytes: n, number of lower bits, length of the upper bits (little-endian
    64, 8 and 64 bits); the lower bits; the upper bits, where value i sets bit
    (value >> lower) + i; the place of every SAMPLE-th set bit (32 bits)."""

    HEAD = "<QBQ"

    def __init__(self, data: bytes):
        self.n, self.low, upper = struct.unpack_from(self.HEAD, data)
        at = struct.calcsize(self.HEAD)
        size = (self.n * self.low + 7) // 8
        self.lower = np.frombuffer(data, np.uint8, size, at)
        self.upper = np.frombuffer(data, np.uint8, (upper + 7) // 8, at + size)
        samples = (self.n + SAMPLE - 1) // SAMPLE
        self.samples = np.frombuffer(data, "<u4", samples, at + size + len(self.upper))

    @classmethod
    def pack(cls, values: np.ndarray) -> bytes:
        v = np.asarray(values, np.uint64)
        n = len(v)
        low = max(int(int(v[-1]) // n).bit_length() - 1, 0) if n else 0
        bits = (v[:, None] >> np.arange(low, dtype=np.uint64)[None, :]) & np.uint64(1)
        lower = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        places = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
        length = int(places[-1]) + 1 if n else 0
        upper = np.zeros(length, np.uint8)
        upper[places] = 1
        return (struct.pack(cls.HEAD, n, low, length) + lower + np.packbits(upper, bitorder="little").tobytes()
                + places[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        """Lower bits of value i."""
        if not self.low:
            return 0
        first, last = i * self.low, (i + 1) * self.low
        word = int.from_bytes(self.lower[first // 8:(last + 7) // 8].tobytes(), "little")
        return word >> (first % 8) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """Value i: the place of set bit i, from the nearest sample on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        word = int(self.upper[byte]) >> (at % 8) << (at % 8)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.upper[byte])
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return (place - i) << self.low | self._low(i)

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[:self.n]
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        bits = np.unpackbits(self.lower, count=self.n * self.low, bitorder="little").reshape(self.n, self.low)
        return high | (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class Recent(dict):
    """Values of recent short chunks: at most ``limit`` new ones and as many older ones."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def __missing__(self, chunk: bytes):
        got = self.old.get(chunk)
        if got is not None:
            self.put(chunk, got)
        return got

    def put(self, chunk: bytes, value: bytes) -> None:
        if len(chunk) > 64:
            return
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[chunk] = value


class Encoder:
    """Token ids of texts by a tokenizers file.

    Texts are cut where the byte level splitter cuts as well, and only chunks
    that were not seen lately go to the library: ``JOINT`` of them in one call
    text, whose ids are dealt back to the chunks by the tokens' lengths in bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        steps = str(self.tokenizer.pre_tokenizer)
        # chunks keep the ids only for the plain byte level splitter without a normaliser
        self.cuts = (self.tokenizer.normalizer is None and steps.startswith("ByteLevel(")
                     and "add_prefix_space=False" in steps and "use_regex=True" in steps)
        # a byte level token has one character for each byte
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        for i, added in self.tokenizer.get_added_tokens_decoder().items():
            self.lengths[i] = len(added.content.encode())
        self.recent = Recent(CACHE)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, new: list[bytes]) -> list[bytes]:
        """The ids of chunks."""
        out: list[bytes] = [b""] * len(new)
        joint = [i for i, c in enumerate(new) if len(c) > 1 and c[0] == 0x20 and not (ONE_BYTE_SPACE[c[1]] or MAY_BE_SPACE[c[1]])]
        groups = [joint[i:i + JOINT] for i in range(0, len(joint), JOINT)]
        rest = set(range(len(new))) - set(joint)
        for first in range(0, len(groups), CALL):
            some = groups[first:first + CALL]
            for group, ids in zip(some, self._ids([_text(b"".join(new[i] for i in g)) for g in some])):
                ends = np.cumsum([len(new[i]) for i in group])
                stops = np.cumsum(self.lengths[ids])
                at = np.searchsorted(stops, ends)
                if not len(stops) or stops[-1] != ends[-1] or not np.array_equal(stops[at], ends):
                    rest |= set(group)  # a token that spans chunks, or bytes that are not UTF-8
                    continue
                for i, a, b in zip(group, [0, *(at[:-1] + 1).tolist()], (at + 1).tolist()):
                    out[i] = ids[a:b].tobytes()
        last = sorted(rest)
        for first in range(0, len(last), JOINT * CALL):
            some = last[first:first + JOINT * CALL]
            for i, ids in zip(some, self._ids([_text(new[i]) for i in some])):
                out[i] = ids.tobytes()
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        ids, ends = self.flat(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, and the bounds of the texts."""
        if not self.cuts:
            texts = texts.cast(pa.large_binary())
            made = [i for t in texts.to_pylist() for i in self._ids([_text(t or b"")])]
            return np.concatenate([np.zeros(0, self.dtype), *made]), np.cumsum([0, *map(len, made)])
        distinct, codes, first = coded_chunks(texts)
        chunks = distinct.to_pylist()
        known = list(map(self.recent.__getitem__, chunks))
        todo = [i for i, ids in enumerate(known) if ids is None]
        for i, ids in zip(todo, self._new([chunks[i] for i in todo])):
            known[i] = ids
            self.recent.put(chunks[i], ids)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(known), self.dtype)
        ids, ends = gather(flat, np.cumsum(sizes) - sizes, sizes, codes)
        return ids, ends[first]


def _text(chunk: bytes) -> str:
    return chunk.decode("utf-8", "replace")


def encoder(path: str) -> Encoder:
    """The worker process's encoder; it outlives a task."""
    state = sys.modules.setdefault("_eventlake_tokens_state", types.ModuleType("_eventlake_tokens_state"))
    if getattr(state, "path", None) != path:
        state.path, state.encoder = path, Encoder(path)
    return state.encoder


def _packed(path: str, end_id: int, block_tokens: int):
    """Function from (shard, doc_id, text) rows in order to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        end = np.array([end_id], encode.dtype).tobytes()
        width = encode.dtype.itemsize
        texts: list[bytes] = []
        doc_ids: list[int | None] = []
        held = block = docs_before = tokens_before = 0
        shard = None

        def out() -> pa.RecordBatch:
            lengths = np.array([len(t) // width for t in texts], np.uint64)
            some = [d for d in doc_ids if d is not None]
            base = some[0] if some else 0
            row = {"shard": shard, "block": block, "shard_doc": docs_before, "shard_token": tokens_before,
                   "n_docs": len(texts), "n_tokens": int(lengths.sum()), "n_null": len(doc_ids) - len(some),
                   "base": base, "width": width, "ids": b"".join(texts), "ends": EliasFano.pack(np.cumsum(lengths)),
                   "doc_ids": EliasFano.pack(np.array([d - base for d in some], np.uint64))}
            kinds = {"shard": pa.int32(), "block": pa.int32(), "n_docs": pa.int32(), "n_null": pa.int32(),
                     "width": pa.int32(), "ids": pa.binary(), "ends": pa.binary(), "doc_ids": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.int64())) for k, v in row.items()],
                                              list(row))

        for parts in runs(batches, "text", CODED_BYTES):
            shard = parts[0].column(0)[0].as_py()
            all_ids, ends = encode.flat(pa.concat_arrays([p.column(2).cast(pa.large_binary()) for p in parts]))
            ends = ends.tolist()
            at = 0
            for part in parts:
                for doc_id in part.column(1).to_pylist():
                    ids = all_ids[ends[at]:ends[at + 1]].tobytes() + end
                    at += 1
                    if texts and held + len(ids) > block_tokens * width:
                        made = out()
                        yield made
                        block += 1
                        docs_before += len(texts)
                        tokens_before += held // width
                        texts, doc_ids, held = [], [], 0
                    texts.append(ids)
                    doc_ids.append(doc_id)
                    held += len(ids)
        if texts:
            yield out()

    return run


def write(docs: DataFrame, tokenizer: str, out: str, text: str = "text", doc_id: str = "doc_id",
          end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> str:
    """Write the token files of ``docs`` to the folder ``out``; returns ``out``.

    The rows are dealt once, by ranges of doc_id and of a hash of the text, which
    spreads rows that share an id or have none; each task sorts, encodes and
    writes its shard."""
    narrow = docs.select(quoted(doc_id).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    by = ["doc_id", F.xxhash64("text")]
    order = narrow.repartitionByRange(*by).sortWithinPartitions(*by)
    order = order.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    map_arrow(order, _packed(tokenizer, end_id, block_tokens), BLOCK).write.parquet(out)
    return out


def shards(spark: SparkSession, path: str) -> DataFrame:
    """(shard, first_doc, first_token): documents and ids before each shard; one row per shard."""
    blocks = spark.read.schema(BLOCK).parquet(path).select("shard", "n_docs", "n_tokens")
    totals = blocks.groupBy("shard").agg(F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("first_doc"),
                         F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first_token"))


def _boundaries(row: dict) -> tuple[np.ndarray, list]:
    """Ends of a block's documents, from 0, and their doc_ids."""
    ends = np.r_[np.uint64(0), EliasFano(row["ends"]).all()].astype(np.int64)
    own = EliasFano(row["doc_ids"]).all()
    return ends, [None] * row["n_null"] + [row["base"] + int(d) for d in own]


def document(row: dict, i: int) -> np.ndarray:
    """The ids of document ``i`` of a block, by two selects and no decoding of the others."""
    ends = EliasFano(row["ends"])
    first, last = ends.select(i - 1) if i else 0, ends.select(i)
    kind = "<u2" if row["width"] == 2 else "<u4"
    return np.frombuffer(row["ids"], kind, last - first, first * row["width"])


def _per_document(compute, fields: str, files: DataFrame, names: list[str]) -> DataFrame:
    """Rows per document from blocks: doc_id, start, n_tokens and ``compute`` of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends, doc_ids = _boundaries(row)
                ids = np.frombuffer(row["ids"], "<u2" if row["width"] == 2 else "<u4")
                first = row["first_token"] + row["shard_token"]
                more = compute([ids[a:b] for a, b in zip(ends, ends[1:])])
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(first + ends[:-1]),
                                                  pa.array(np.diff(ends)), more], ["doc_id", "start", "n_tokens", *names])

    return map_arrow(files, run, f"doc_id bigint, start bigint, n_tokens bigint, {fields}")


def _located(spark: SparkSession, path: str) -> DataFrame:
    few, fits = bounded_side(shards(spark, path), MAX_SHARDS_TO_BROADCAST, "token_shards")
    blocks = spark.read.schema(BLOCK).parquet(path)
    return blocks.join(F.broadcast(few) if fits else few, "shard")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a file set."""
    return _per_document(lambda docs: pa.array([d.astype(np.int32) for d in docs], pa.list_(pa.int32())),
                         "ids array<int>", _located(spark, path), ["ids"])


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): crc32 of each document's ids as little-endian 32-bit numbers."""
    return _per_document(lambda docs: pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in docs], pa.int64()),
                         "ids_crc32 bigint", _located(spark, path), ["ids_crc32"])


def write_to_shared(docs: DataFrame, tokenizer: str, **kw) -> str:
    """``write`` to a new folder of the shared folder."""
    return write(docs, tokenizer, table_path(docs, "token_files"), **kw)
