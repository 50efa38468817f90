"""Byte-level BPE with Spark higher-order functions.

``encode_words`` turns distinct words into token ids: the word's bytes become
token ids, and a fold joins, again and again, the two neighbours whose merge
has the lowest rank (the leftmost of equals), until no pair has a rank. Ranks
come from the rank file as a map of token pairs in arrays: literal ones in
``encode_words``, a broadcast row of them in ``encode``.

``encode`` applies it to documents. Texts are split by the pattern once and
written as blocks: a bounded amount of text as the block's distinct words and
indices of them. The most frequent words of the corpus (``HOT_WORDS``, counted
over all blocks) are encoded once and given to every task; every other word is
encoded once for each run of blocks of a task in which it occurs. So nothing is
shuffled but the word counts, and no dictionary grows with the corpus. ``decode`` concatenates
the tokens' binary pieces.

Defined cases: null and empty texts have no tokens; repeated rows give
repeated results; an empty table gives no rows. Bytes that are not UTF-8 read
as the replacement character, as Spark itself shows them.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import free_prefix, map_arrow, quoted, stage, table_path
from eventlake.llm.text import BASE, as_bytes, mix64, range_hash, runs

HOT_WORDS = 400_000  # words of at most HOT_BYTES bytes, so at most 25 MB
HOT_BYTES = 48
BLOCK_BYTES = 4_000_000  # text of one block
KEPT_WORDS = 200_000  # other words that a task remembers from block to block
PAIR_BITS, PLACE_BITS = 18, 24  # of a token id, and of a place in a word
PAIR = 1 << PAIR_BITS
NONE = PAIR  # in place of a rank


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a .tiktoken file (base64 piece, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def halves(piece: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two pieces whose merge gives ``piece`` when it is encoded by itself, if
    it is reached so. In any longer text, pieces that meet with these bytes are
    the same two: nothing was merged across their outer bounds, so the merges
    inside were those of ``piece`` alone."""
    parts, end = [piece[i:i + 1] for i in range(len(piece))], ranks[piece]
    while len(parts) > 2:
        least, at = end, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1], end)
            if r < least:
                least, at = r, i
        if at < 0:
            return None
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if parts[0] in ranks and parts[1] in ranks else None


def merges(ranks: dict[bytes, int]) -> dict[bytes, tuple[bytes, bytes] | None]:
    """``halves`` of every piece of several bytes."""
    return {piece: halves(piece, ranks) for piece in ranks if len(piece) > 1}


def rank_table(ranks: dict[bytes, int], made: dict) -> dict[str, np.ndarray]:
    """The merges in arrays, found without hashing or search:

    * ``firsts``: what a word's state starts with, by a byte and the next one
      (256: none): the rank of their merge or NONE, and the byte's id;
    * ``bases`` and ``slots``: the merges of a left token lie in ``slots`` at its
      base + the right token, as left * PAIR + rank. The bases are chosen so
      that no two merges meet (displaced rows); free slots name no token."""
    n = max(ranks.values(), default=-1) + 1
    if n >= PAIR:
        raise ValueError(f"ranks must be under {PAIR}")
    pairs = np.array([(ranks[two[0]], ranks[two[1]], ranks[piece]) for piece, two in made.items() if two],
                     np.int64).reshape(-1, 3)
    singles = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
    firsts = np.full((256, 257), NONE << PAIR_BITS + PLACE_BITS, np.int64) + singles[:, None]
    byte_of = np.full(n, -1)
    byte_of[singles] = np.arange(256)
    short = pairs[(byte_of[pairs[:, 0]] >= 0) & (byte_of[pairs[:, 1]] >= 0)]
    firsts[byte_of[short[:, 0]], byte_of[short[:, 1]]] += (short[:, 2] - NONE) << PAIR_BITS + PLACE_BITS

    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    lefts, begin, size = np.unique(pairs[:, 0], return_index=True, return_counts=True)
    bases, used, base = np.zeros(n, np.int64), np.zeros(2 * n, bool), 0
    for i in np.argsort(-size, kind="stable")[:np.count_nonzero(size > 1)]:  # the largest rows first
        right = pairs[begin[i]:begin[i] + size[i], 1]
        while used[base + right].any():
            base += 1
            if base + n > len(used):
                used = np.concatenate([used, np.zeros(n, bool)])
        bases[lefts[i]] = base
        used[base + right] = True
    alone = np.flatnonzero(size == 1)  # in what is free
    used = np.concatenate([used, np.zeros(len(alone), bool)])
    bases[lefts[alone]] = n + np.flatnonzero(~used[n:])[:len(alone)] - pairs[begin[alone], 1]
    at = bases[pairs[:, 0]] + pairs[:, 1]
    slots = np.full(int(at.max(initial=0)) + 1, (PAIR - 1) * PAIR, np.int64)
    slots[at] = pairs[:, 0] * PAIR + pairs[:, 2]
    return {"firsts": firsts.ravel(), "bases": bases.astype(np.int32), "slots": slots}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once. (As an element of a transformed
    array the value would have its type derived anew in every evaluation.)"""
    return F.aggregate(F.array().cast("array<int>"), value, lambda x, _: x, body)


def _slot(left: Column, right: Column, table: tuple) -> Column:
    """The rank of the merge of two token ids, or NONE (also where one is missing)."""
    found = F.get(table[2], F.get(table[1], left.cast("int")) + right.cast("int"))
    # a slot of the same left token leaves its rank, any other slot at least PAIR
    return F.least(found.bitwiseXOR(F.shiftleft(left, PAIR_BITS)), F.lit(NONE).cast("bigint"))


def encode_word(word: Column, table: tuple) -> Column:
    """Token ids (array<int>) of a binary word, by the arrays of ``rank_table``.

    The fold's state has one long per token: the rank of its merge with the next
    one, its place in the word and its id. The least entry is the next merge
    (the leftmost of equal ranks); a merge replaces two entries and looks up
    the ranks of the new token with its two neighbours."""
    n = F.octet_length(word)
    big = lambda x: F.lit(x).cast("bigint")
    top = PAIR_BITS + PLACE_BITS
    rest, places = big((1 << top) - 1), big((1 << top) - PAIR)

    def token(x: Column) -> Column:
        return x.bitwiseAND(big(PAIR - 1))

    def entry(left: Column, right: Column, kept: Column) -> Column:
        return F.shiftleft(_slot(left, right, table), top) + kept

    def step(s: Column, _: Column) -> Column:
        def merge(least: Column) -> Column:
            made = F.shiftright(least, top)  # the merge's rank is the id of what it makes

            def put(i: Column) -> Column:  # 1-based place of the left one of the two
                before = F.get(s, i - 2)
                new = entry(made, token(F.get(s, i + 1)), least.bitwiseAND(places) + made)
                return F.when(i > 1, F.concat(
                    F.slice(s, 1, i - 2), F.array(entry(token(before), made, before.bitwiseAND(rest)), new),
                    F.slice(s, i + 2, n))).otherwise(F.concat(F.array(new), F.slice(s, 3, n)))

            # counted, as array_position leaves its loop by an exception, which takes most of a step
            before = F.filter(s, lambda x: x.bitwiseAND(places) < least.bitwiseAND(places))
            return F.when(least >= big(NONE << top), s).otherwise(let(F.size(before) + 1, put))

        return let(F.array_min(s), merge)

    def start(text: Column) -> Column:  # one character per byte
        codes = F.transform(F.sequence(F.lit(1), n), lambda i: F.ascii(F.substring(text, i, F.lit(1))))
        return let(codes, lambda codes: F.transform(codes, lambda c, i: F.get(
            table[0], c * 257 + F.coalesce(F.get(codes, i + 1), F.lit(256))) + i * big(PAIR)))

    first = let(F.decode(word, "ISO-8859-1"), start)
    ids = F.aggregate(F.sequence(F.lit(2), n), first, step, lambda s: F.transform(s, lambda x: token(x).cast("int")))
    one = let(F.decode(word, "ISO-8859-1"), lambda text: F.array(
        token(F.get(table[0], F.ascii(text) * 257 + 256)).cast("int")))
    return F.when(n > 1, ids).when(n == 1, one).when(n == 0, F.array().cast("array<int>"))


TABLE = "firsts array<bigint>, bases array<int>, slots array<bigint>"


class Encoder:
    """``encode_words`` for DataFrames: the rank table is a broadcast row of its
    arrays. As literals they would stand in every plan, its text and its events."""

    def __init__(self, ranks: dict[bytes, int]):
        made = merges(ranks)
        # pieces that their own merges do not reach are tokens only as whole words, as in the library
        self.whole = {p: ranks[p] for p, two in made.items() if two is None}
        self.arrays = rank_table(ranks, made)

    def ids(self, words: Column, table: tuple) -> Column:
        """Token ids of an array of binary words, by columns of the table's arrays."""
        def encode(w: Column) -> Column:
            out = encode_word(w, table)
            for piece, rank in self.whole.items():
                out = F.when(w == F.lit(piece), F.array(F.lit(rank))).otherwise(out)
            return out

        return F.transform(words, encode)

    def add(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with the ids of its column ``words`` in ``column``; rows stay in order."""
        one = pa.table({k: pa.array([v], pa.list_(pa.from_numpy_dtype(v.dtype))) for k, v in self.arrays.items()})
        own = free_prefix([*df.columns, column], "bpe_")
        table = df.sparkSession.createDataFrame(one, TABLE).toDF(*[own + k for k in self.arrays])
        ids = self.ids(F.col("words"), tuple(F.col(own + k) for k in self.arrays))
        return df.crossJoin(F.broadcast(table)).select(*df.columns, ids.alias(column))


def encode_words(words: Column, ranks: dict[bytes, int]) -> Column:
    """Token ids (array<array<int>>) of an array of binary words, each encoded by
    itself; the rank table as one literal each for its arrays."""
    encoder = Encoder(ranks)
    types = dict(zip(encoder.arrays, ("bigint", "int", "bigint")))
    firsts, bases, slots = (F.from_json(F.lit(json.dumps(v.tolist(), separators=(",", ":"))), f"array<{types[k]}>")
                            for k, v in encoder.arrays.items())
    return let(firsts, lambda f: let(bases, lambda b: let(slots, lambda t: encoder.ids(words, (f, b, t)))))


# Fixed byte classes: white space of one byte (and the separators that some libraries count
# as such), and the first bytes of white space of several bytes in UTF-8.
ONE_BYTE_SPACE = np.zeros(256, bool)
ONE_BYTE_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
MAY_BE_SPACE = np.zeros(256, bool)
MAY_BE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
LONG_SPACES = np.array([0xC285, 0xC2A0, 0xE19A80, 0xE2819F, 0xE38080, 0xE280A8, 0xE280A9, 0xE280AF,
                        *range(0xE28080, 0xE2808B)])


def chunk_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts (bytes with row offsets) are cut before single spaces, where
    every pattern of this family cuts too: a space that ends its white space
    and is followed by a word. Every text that is not empty starts a chunk."""
    at = np.flatnonzero(raw[:-1] == 0x20)
    nxt = raw[at + 1]
    last = np.zeros(len(raw) + 1, bool)  # the last byte of a row has no next one
    last[offsets[1:] - 1] = True
    keep = ~(ONE_BYTE_SPACE[nxt] | last[at])
    doubt = np.flatnonzero(keep & MAY_BE_SPACE[nxt])
    if len(doubt):
        padded = np.concatenate([raw, np.zeros(3, np.uint8)]).astype(np.int64)
        p = at[doubt]
        two = padded[p + 1] << 8 | padded[p + 2]
        keep[doubt] = ~(np.isin(two, LONG_SPACES) | np.isin(two << 8 | padded[p + 3], LONG_SPACES))
    starts = np.zeros(len(raw), bool)
    starts[at[keep]] = True
    starts[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(starts)


def coded_chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct chunks of the texts, the chunks of all texts in turn (as
    indices of the distinct ones) and each text's first chunk."""
    raw, offsets = as_bytes(texts)
    if not len(raw):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    starts = chunk_starts(raw, offsets)
    ends = pa.py_buffer(np.append(starts, len(raw)).astype(np.int64))
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, ends, pa.py_buffer(raw)]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(starts, offsets)


def chunks(text: str) -> list[str]:
    """The chunks of one text."""
    distinct, codes, _ = coded_chunks(pa.array([text]))
    return [distinct[i].as_py().decode() for i in codes.tolist()]


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The words of a text; white space is the Unicode property, as in the library."""
    return regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")).findall


def words_of_chunks(chunks: pa.Array, find: Callable[[str], list[str]]) -> tuple[pa.Array, np.ndarray]:
    """The words of all chunks in turn (joint ones first), and each chunk's (first word, number of words).

    Joint chunks start with a space and a word: they are cut from whatever
    precedes them, so they are split as one text. The others are starts of
    texts and are split one by one, as are all where the pattern leaves gaps."""
    raw, offsets = as_bytes(chunks)
    sizes = np.diff(offsets)
    joint = np.zeros(len(chunks), bool)
    some = np.flatnonzero(sizes > 1)
    second = raw[offsets[some] + 1]
    joint[some] = (raw[offsets[some]] == 0x20) & ~ONE_BYTE_SPACE[second] & ~MAY_BE_SPACE[second]
    text = b"".join(chunks.filter(pa.array(joint)).to_pylist())
    ends = np.cumsum(sizes[joint])
    together: list[str] = []
    try:
        together = find(text.decode())
        lengths = pc.binary_length(pa.array(together, pa.large_string())).to_numpy()
        stops = np.cumsum(lengths)
        if lengths.sum() != len(text) or not np.isin(ends, stops).all():
            raise ValueError
        counts = np.diff(np.searchsorted(stops, ends, side="right"), prepend=0)
    except ValueError:  # bytes that are not UTF-8, or gaps
        joint[:], together, counts = False, [], np.zeros(0, np.int64)
    apart = [find(c.decode("utf-8", "replace")) for c in chunks.filter(pa.array(~joint)).to_pylist()]
    each = np.zeros(len(chunks), np.int64)
    each[joint], each[~joint] = counts, [len(x) for x in apart]
    first = np.zeros(len(chunks), np.int64)
    first[joint] = np.cumsum(counts) - counts
    first[~joint] = len(together) + np.cumsum(each[~joint]) - each[~joint]
    words = pa.array(together + list(chain.from_iterable(apart)), pa.string())
    return words.cast(pa.binary()), np.stack([first, each])


def _split(pattern: str) -> Callable:
    """Function from (doc_id, text) rows to blocks: the distinct words of some
    texts with their counts, and the texts as indices of these words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = splitter(pattern)

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            distinct, codes, first = coded_chunks(pa.concat_arrays([p.column(1).cast(pa.large_binary()) for p in parts]))
            words, (starts, sizes) = words_of_chunks(distinct, find)
            coded = words.dictionary_encode()
            index, ends = gather(coded.indices.to_numpy().astype(np.uint32), starts, sizes, codes)
            counts = np.bincount(index, minlength=len(coded.dictionary))
            tokens = index.astype(np.uint16) if len(counts) <= 1 << 16 else index
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays(
                [one(pa.concat_arrays([p.column(0) for p in parts])), one(pa.array(np.diff(ends[first]), pa.int32())),
                 pa.array([tokens.tobytes()], pa.binary()), one(coded.dictionary), one(pa.array(counts, pa.int32()))],
                ["doc_ids", "sizes", "tokens", "words", "counts"])

        for parts in runs(batches, "text", BLOCK_BYTES):
            yield block(parts)
            pa.default_memory_pool().release_unused()

    return run


def split(docs: DataFrame, pattern: str) -> DataFrame:
    """(doc_id, text) rows as a written table of blocks (see ``_split``)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    blocks = map_arrow(docs.select("doc_id", "text"), _split(pattern), f"doc_ids array<{id_type}>, sizes array<int>, "
                       "tokens binary, words array<binary>, counts array<int>")
    path = table_path(docs, "bpe_blocks")
    # small row groups: a reader holds one of them
    blocks.write.option("compression", "zstd").option("parquet.block.size", 4 * BLOCK_BYTES).parquet(path)
    return docs.sparkSession.read.schema(blocks.schema).parquet(path)


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, n) over all blocks, for words of at most HOT_BYTES bytes."""
    each = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("w"))
    each = each.select(F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    return each.where(F.octet_length("word") <= HOT_BYTES).groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The ``size`` words of the largest ``n`` (of equal ones the first words).
    The cut comes from the number of words per count; only the words at the
    cut are put in order, by ranges, of which one range is cut itself."""
    counts = stage(counts, "bpe_counts")

    def cut(groups: DataFrame, order, size: int):
        """The first group that does not fit whole, with the words that fit of it."""
        upto = F.sum("words").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        over = groups.withColumn("upto", upto).where(F.col("upto") > size).orderBy("upto").limit(1).collect()
        return (over[0][0], size - (over[0].upto - over[0].words)) if over else (None, 0)

    count = F.count(F.lit(1)).alias("words")
    n, left = cut(counts.groupBy("n").agg(count), F.col("n").desc(), size)
    if n is None:
        return counts.select("word")
    top = counts.where(F.col("n") > n).select("word")
    if left:
        tied = counts.where(F.col("n") == n).repartitionByRange("word")
        tied = stage(tied.select(F.spark_partition_id().alias("part"), "word"), "bpe_tied")
        part, rest = cut(tied.groupBy("part").agg(count), F.col("part"), left)
        top = top.unionByName(tied.where(F.col("part") < part).select("word"))
        if rest:
            top = top.unionByName(tied.where(F.col("part") == part).select("word").orderBy("word").limit(rest))
    return top


def hot_dictionary(docs: DataFrame, ranks: dict[bytes, int], pattern: str, size: int = HOT_WORDS) -> tuple:
    """The ``size`` most frequent words of documents and their ids: (words, flat ids, offsets)."""
    words, ids, offsets = hot_table(split(docs, pattern), Encoder(ranks), size)
    return words.to_pylist(), ids, offsets


def hot_table(blocks: DataFrame, encoder: Encoder, size: int = HOT_WORDS) -> tuple:
    """``hot_dictionary`` of texts that are split already, the words as an Arrow array."""
    top = stage(most_frequent(word_counts(blocks), size), "bpe_hot")
    spark = blocks.sparkSession
    groups = F.pmod(F.xxhash64("word"), F.lit(4 * max(spark.sparkContext.defaultParallelism, 1)))
    lists = top.groupBy(groups.alias("g")).agg(F.collect_list("word").alias("words"))
    table = encoder.add(lists.select("words"), "ids").toArrow()  # bounded by size
    words, ids, lengths = [pa.array([], pa.large_binary())], [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for batch in table.to_batches():
        words.append(batch.column(0).flatten().cast(pa.large_binary()))
        lists_of_ids = batch.column(1).flatten()
        lengths.append(lists_of_ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        ids.append(lists_of_ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32))
    return pa.concat_arrays(words), np.concatenate(ids), np.cumsum(np.concatenate(lengths))


def word_hash(words: pa.Array) -> np.ndarray:
    raw, offsets = as_bytes(words)
    return mix64(range_hash(raw.astype(np.uint64) + np.uint64(1), offsets[:-1], offsets[1:], BASE))


def places(words: pa.Array, blob: np.ndarray, bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each word in a list of words (in ascending order of hash;
    bytes and bounds), or -1. Found by hash, compared byte by byte."""
    at = np.searchsorted(hashes, wanted := word_hash(words))
    at[at == len(hashes)] = 0
    raw, offsets = as_bytes(words)
    sizes = np.diff(offsets)
    same = np.zeros(len(words), bool)
    if len(hashes):
        same = (hashes[at] == wanted) & (np.diff(bounds)[at] == sizes)
    some = np.flatnonzero(same)
    theirs, ends = gather(blob, bounds[:-1], np.diff(bounds), at[some])
    ours, _ = gather(raw, offsets[:-1], sizes, some)
    wrong = np.concatenate([[0], np.cumsum(theirs != ours)])
    same[some] = wrong[ends[1:]] == wrong[ends[:-1]]
    return np.where(same, at, -1)


def _look_up(hot_words) -> Callable:
    """Function from blocks to blocks whose tokens are indices of the hot words
    first, then of the other words of this task; a block brings the new ones.
    After ``KEPT_WORDS`` of them the next block starts anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob, bounds, hashes = hot_words.value
        others: dict[bytes, int] = {}
        for batch in batches:
            for i in range(len(batch)):
                anew = len(others) >= KEPT_WORDS
                if anew:
                    others = {}
                known = len(others)
                words = batch.column("words").slice(i, 1).flatten()
                at = places(words, blob, bounds, hashes)
                cold = np.flatnonzero(at < 0)
                at[cold] = [len(hashes) + others.setdefault(w, len(others))
                            for w in words.take(pa.array(cold)).to_pylist()]
                kind = np.uint16 if len(words) <= 1 << 16 else np.uint32
                tokens = np.frombuffer(batch.column("tokens")[i].as_buffer(), kind)
                new = words.take(pa.array(cold[at[cold] >= len(hashes) + known]))  # in the order of their numbers
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids").slice(i, 1), batch.column("sizes").slice(i, 1),
                     pa.array([at.astype(np.uint32)[tokens].tobytes()], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, len(new)], pa.int32()), new), pa.array([anew])],
                    ["doc_ids", "sizes", "tokens", "words", "anew"])

    return run


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[starts[i]:starts[i] + sizes[i]] for i in ``at``, joined, and the bounds of the runs."""
    n = sizes[at]
    ends = np.zeros(len(at) + 1, np.int64)
    np.cumsum(n, out=ends[1:])
    return flat[np.repeat(starts[at] - ends[:-1], n) + np.arange(ends[-1])], ends


def _assemble(hot_ids) -> Callable:
    """Function from encoded blocks to (doc_id, ids) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, offsets = hot_ids.value
        ids, lengths = flat, np.diff(offsets)
        for batch in batches:
            for i in range(len(batch)):
                if batch.column("anew")[i].as_py():
                    ids, lengths = flat, np.diff(offsets)
                doc_ids = batch.column("doc_ids").slice(i, 1).flatten()
                tokens = np.frombuffer(batch.column("tokens")[i].as_buffer(), np.uint32)
                bounds = np.r_[0, np.cumsum(batch.column("sizes").slice(i, 1).flatten().to_numpy())]
                own = batch.column("own").slice(i, 1).flatten()
                sizes = own.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = np.concatenate([ids, own.flatten().to_numpy(zero_copy_only=False).astype(np.int32)])
                lengths = np.concatenate([lengths, sizes])
                starts = np.cumsum(lengths) - lengths
                for first in range(0, len(doc_ids), 256):
                    cut = bounds[first:first + 257]
                    made, ends = gather(ids, starts, lengths, tokens[cut[0]:cut[-1]])
                    lists = pa.ListArray.from_arrays(pa.array(ends[cut - cut[0]], pa.int32()), pa.array(made, pa.int32()))
                    yield pa.RecordBatch.from_arrays([doc_ids.slice(first, 256), lists], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", doc_id: str = "doc_id",
           hot_words: int = HOT_WORDS) -> DataFrame:
    """(doc_id, ids) of every row: the token ids of its whole text."""
    narrow = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    sc = docs.sparkSession.sparkContext
    blocks = split(narrow, pattern)
    encoder = Encoder(ranks)
    words, flat, offsets = hot_table(blocks, encoder, hot_words)
    hashes = word_hash(words)
    order = np.argsort(hashes, kind="stable")
    raw, bounds = as_bytes(words.take(pa.array(order)))
    flat, ends = gather(flat, offsets[:-1], np.diff(offsets), order)
    hot = sc.broadcast((raw.copy(), bounds.astype(np.int64), hashes[order]))
    hot_ids = sc.broadcast((flat, ends))
    pa.default_memory_pool().release_unused()
    left = map_arrow(blocks.drop("counts"), _look_up(hot),
                     f"doc_ids array<{id_type}>, sizes array<int>, tokens binary, words array<binary>, anew boolean")
    return map_arrow(encoder.add(left, "own").drop("words"), _assemble(hot_ids), f"doc_id {id_type}, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``encoded`` with the concatenated binary pieces of its ids in ``column``."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    if column in encoded.columns:
        raise ValueError(f"column exists already: {column}")
    n = max(ranks.values(), default=-1) + 1
    by_rank = [b""] * n
    for piece, rank in ranks.items():
        by_rank[rank] = piece
    flat = np.frombuffer(b"".join(by_rank), np.uint8)
    ends = np.cumsum([0, *map(len, by_rank)])
    pieces = encoded.sparkSession.sparkContext.broadcast((flat, ends[:-1], np.diff(ends)))
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, starts, sizes = pieces.value
        for batch in batches:
            for first in range(0, len(batch), 64):
                part = batch.slice(first, 64)
                lists = part.column(at)
                tokens = lists.flatten().to_numpy(zero_copy_only=False)  # of the rows that are not null
                size = sizes[tokens]
                total = np.r_[0, np.cumsum(size)]
                raw = flat[np.repeat(starts[tokens] - total[:-1], size) + np.arange(total[-1])].tobytes()
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = total[np.cumsum(counts)] if len(counts) else []
                out = [raw[a:b] if ok else None
                       for a, b, ok in zip([0, *ends[:-1]], ends, lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())],
                                                 [*part.schema.names, column])

    return map_arrow(encoded, run, StructType([*encoded.schema.fields, StructField(column, BinaryType())]))
