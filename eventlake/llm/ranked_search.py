"""Ranked lexical search by pipelined term partitioning.

The terms of the queries ("items") are dealt to a few owners, rare terms first.
Every item is a bundle that visits the owners one after the other and carries a
sparse accumulator (document row -> score so far). A stage is one cogroup of
the bundles with the postings of that stage's owner: it adds the integer
contributions of the owner's terms. The last stage picks each item's best
documents. Scores are the integer BM25 form of ``contribution``.

Scale: accumulators and postings are dealt by owner and document shard
(a hash of the row, so repeated ids and hot sources spread), so a bundle is the
accumulator of one item over at most ``SHARD_DOCS`` documents, however long a
posting list is. Before a bundle travels on, documents leave its accumulator
that cannot be among the shard's best: those whose score so far plus the most
the remaining owners can add stays under the k-th score so far. That bound is
exact (contributions are never negative), so no result is lost. Only the terms
of the items leave the text scan; they are a broadcast of at most ``MAX_TERMS``
entries. More items than that are searched in several batches over all rows.

Defined cases: null and empty texts have no term and no rank; items without a
known term give no rows; rows equal in ``item_id`` are one item with the terms
of all; every document row is ranked by itself, also where rows repeat an id or
have none (null ids come last among equal scores); an empty table gives no
rows; other columns are not read. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import map_arrow, quoted, stage, stage_counted, table_path
from eventlake.llm.text import as_bytes, slices, word_hashes

MAX_TERMS = 2_000_000  # (item, term) pairs of a batch of items
OWNERS = 4
SHARD_DOCS = 65_536  # documents of a shard at most, about
SHARDS = 64  # shards of a small corpus, if it has documents for them

# Fixed byte classes of the term pattern: ASCII letters and digits and everything beyond ASCII are inside.
BETWEEN = np.ones(256, bool)
BETWEEN[0x30:0x3A] = BETWEEN[0x41:0x5B] = BETWEEN[0x61:0x7B] = BETWEEN[0x80:] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts and each text's first term."""
    raw, offsets = as_bytes(texts)
    return word_hashes(LOWER[raw], offsets, between=BETWEEN)


def contribution(tf, m):
    """The part of a term's score that its weight multiplies (longs; numpy or columns)."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def length_norm(n, docs: int, total: int):
    """m of a document of ``n`` terms in a corpus of ``docs`` documents and ``total`` terms."""
    return 50 + (50 * n * docs) // max(total, 1)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, term) rows, each pair once; ``term`` is the hash."""
    narrow = items.select(quoted(item_id).alias("item_id"), quoted(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                terms, first = term_hashes(part.column(1))
                rows = np.repeat(np.arange(len(part)), np.diff(first))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(terms.view(np.int64))],
                                                 ["item_id", "term"])

    id_type = narrow.schema["item_id"].dataType.simpleString()
    return map_arrow(narrow, run, f"item_id {id_type}, term bigint").distinct()


def _found(vocabulary) -> Callable:
    """Function from (row, doc_id, text) to the documents that have a term:
    their length and the counts of the terms of ``vocabulary`` (as indices)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for part in slices(batch, "text"):
                terms, first = term_hashes(part.column(2))
                n = np.diff(first)
                at = np.searchsorted(known, terms)
                hit = at < len(known)
                hit[hit] = known[at[hit]] == terms[hit]
                rows = np.repeat(np.arange(len(part), dtype=np.int64), n)[hit]
                pairs, tf = np.unique(rows << np.int64(32) | at[hit], return_counts=True)
                ends = np.searchsorted(pairs >> np.int64(32), np.arange(len(part) + 1))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v.astype(np.int32)))
                         for v in (pairs & np.int64(0xFFFFFFFF), tf)]
                out = pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), *lists],
                                                 ["row", "doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return run


def _by_owner(owners, last: int) -> Callable:
    """Function that cuts each document's postings into one row per owner; the
    last owner gets a row of every document, so it can tell its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = owners.value
        for batch in batches:
            sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(batch)), sizes)
            terms = batch.column("terms").flatten().to_numpy(zero_copy_only=False)
            tfs = batch.column("tfs").flatten().to_numpy(zero_copy_only=False)
            for k in range(last + 1):
                mine = owner[terms] == k
                ends = np.searchsorted(rows[mine], np.arange(len(batch) + 1))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v[mine], pa.int32()))
                         for v in (terms, tfs)]
                out = pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(batch), k, np.int32)), *[batch.column(c) for c in ("shard", "row", "doc_id", "m")],
                     *lists], ["owner", "shard", "row", "doc_id", "m", "terms", "tfs"])
                yield out if k == last else out.filter(pa.array(np.diff(ends) > 0))

    return run


def _visit(tables, owner: int, last: bool, top: int, id_type: pa.DataType) -> Callable:
    """The stage of one owner: function of a shard's bundles and postings."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        weights, most, owners, firsts, item_terms_ = tables.value
        postings = postings.combine_chunks()
        own = postings.column("row").to_numpy()
        carried = [np.asarray(x, np.int64) for x in bundles.column("rows").to_pylist()]
        rows = np.unique(np.concatenate([own, *carried])) if len(carried) else own
        sizes = pc.list_value_length(postings.column("terms")).to_numpy()
        flat = lambda c: pc.list_flatten(postings.column(c)).to_numpy()
        terms, tfs = flat("terms"), flat("tfs").astype(np.int64)
        doc = np.repeat(np.searchsorted(rows, own), sizes)
        points = weights[terms] * contribution(tfs, np.repeat(postings.column("m").to_numpy(), sizes))
        order = np.argsort(terms, kind="stable")
        terms, doc, points = terms[order], doc[order], points[order]
        ids = None
        if last:  # the id of every row of the shard
            back = np.argsort(own)
            ids = postings.column("doc_id").take(pa.array(back))  # in the order of ``rows``: all are here
        out_items, out_rows, out_scores = [], [], []
        for i, old, scores in zip(bundles.column("item").to_pylist(), carried, bundles.column("scores").to_pylist()):
            acc = np.zeros(len(rows), np.int64)
            acc[np.searchsorted(rows, old)] = scores
            mine = item_terms_[firsts[i]:firsts[i + 1]]
            for t in mine[owners[mine] == owner]:
                a, b = np.searchsorted(terms, [t, t + 1])
                acc[doc[a:b]] += points[a:b]
            live = np.flatnonzero(acc)
            if len(live) > top:
                rest = 0 if last else int(most[mine[owners[mine] > owner]].sum())
                kth = np.partition(acc[live], len(live) - top)[len(live) - top]
                live = live[acc[live] + rest >= kth]
            if last and len(live) > top:
                some = pa.table({"score": acc[live], "id": ids.take(pa.array(live)), "at": live})
                best = pc.sort_indices(some, [("score", "descending"), ("id", "ascending")], null_placement="at_end")
                live = some.column("at").take(best[:top]).to_numpy()
            if last:
                out_items.append(np.full(len(live), i))
            else:
                out_items.append(i)
            out_rows.append(live if last else rows[live])
            out_scores.append(acc[live])
        if last:
            at = np.concatenate([np.zeros(0, np.int64), *out_rows])
            return pa.table({"item": pa.array(np.concatenate([np.zeros(0, np.int64), *out_items]), pa.int32()),
                             "doc_id": ids.take(pa.array(at)).cast(id_type),
                             "score": pa.array(np.concatenate([np.zeros(0, np.int64), *out_scores]), pa.int64())})
        shard = bundles.column("shard").to_pylist()
        return pa.table({"item": pa.array(out_items, pa.int32()), "shard": pa.array(shard, pa.int32()),
                         "rows": pa.array(out_rows, pa.list_(pa.int64())),
                         "scores": pa.array(out_scores, pa.list_(pa.int64()))})

    return run


def _search_batch(docs: DataFrame, pairs: list, ids: list, top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each shard for the items of
    one batch, ``pairs`` being their (item index, term) pairs."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    item = np.array([i for i, _ in pairs], np.int64)
    known, term = np.unique(np.array([t for _, t in pairs], np.int64).view(np.uint64), return_inverse=True)
    order = np.lexsort((term, item))
    firsts = np.searchsorted(item[order], np.arange(len(ids) + 1))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = map_arrow(docs, _found(sc.broadcast(known)),
                      f"row bigint, doc_id {id_type}, n bigint, terms array<int>, tfs array<int>")
    found, seen = stage_counted(found, "search_found", terms=F.sum("n"))
    n_docs, total = int(seen["rows"]), int(seen["terms"])
    shards = max(-(-n_docs // SHARD_DOCS), min(SHARDS, -(-n_docs // 1024)), 1)
    m = F.lit(50).cast("long") + F.expr(f"(50 * n * {n_docs}L) div {max(total, 1)}L")
    found = found.withColumn("m", m).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))

    each = found.select("m", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select(
        F.col("p.terms").alias("term"), F.expr("(1000000000L * p.tfs) div (1000L * p.tfs + 20L * m)").alias("points"))
    stats = each.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("points").alias("most")).toArrow()
    df, most = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)  # a row per term of the items
    df[stats.column("term").to_numpy()] = stats.column("df").to_numpy()
    most[stats.column("term").to_numpy()] = stats.column("most").to_numpy()
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    ceiling = weight(n_docs, 0) + 1
    owners = np.clip((ceiling - weights) * OWNERS // ceiling, 0, OWNERS - 1).astype(np.int32)  # rare terms first

    dealt = map_arrow(found.drop("n"), _by_owner(sc.broadcast(owners), OWNERS - 1),
                      f"owner int, shard int, row bigint, doc_id {id_type}, m bigint, terms array<int>, tfs array<int>")
    path = table_path(docs, "search_postings")
    dealt.write.partitionBy("owner").parquet(path)
    postings = spark.read.schema(dealt.schema).parquet(path)
    tables = sc.broadcast((weights, weights * most, owners, firsts, term[order]))
    bundles = (spark.range(len(ids)).select(
        F.col("id").cast("int").alias("item"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.expr("cast(array() as array<bigint>)").alias("rows"), F.expr("cast(array() as array<bigint>)").alias("scores")))
    out_type = pa.schema([found.select("doc_id").limit(0).toArrow().schema.field(0)]).field(0).type
    for k in range(OWNERS):
        last = k == OWNERS - 1
        to = F.lit(k).alias("owner")  # the bundles move on to this owner's tasks
        left = bundles.withColumn("owner", to).groupBy("owner", "shard")
        right = postings.where(F.col("owner") == k).groupBy("owner", "shard")
        bundles = left.cogroup(right).applyInArrow(
            _visit(tables, k, last, top, out_type),
            f"item int, doc_id {id_type}, score bigint" if last
            else "item int, shard int, rows array<bigint>, scores array<bigint>")
    return bundles


def search(docs: DataFrame, items: DataFrame, top: int = 50, text: str = "text", doc_id: str = "doc_id",
           item_text: str = "text", item_id: str = "item_id", max_terms: int = MAX_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents of the
    highest score above 0, equal scores by ascending id."""
    spark = docs.sparkSession
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), quoted(doc_id).alias("doc_id"),
                         quoted(text).alias("text"))
    terms, seen = stage_counted(item_terms(items, item_text, item_id), "search_items")
    batches = max(-(-int(seen["rows"]) // max_terms), 1)
    out = None
    for b in range(batches):
        mine = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == b) if batches > 1 else terms
        got = mine.toArrow()  # about max_terms pairs
        ids = got.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        names = ids.dictionary.to_pylist()
        pairs = list(zip(ids.indices.to_pylist(), got.column("term").to_pylist()))
        found = _search_batch(narrow, pairs, names, top)
        schema = f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}"
        named = spark.createDataFrame(list(enumerate(names)), schema)
        found = found.join(F.broadcast(named), "item").select("item_id", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = stage(out, "search_best").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
