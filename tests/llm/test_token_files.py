import random
import zlib

import numpy as np
import pytest
import public_tokenizers as P
from tokenizers import Tokenizer

from eventlake.llm import token_files as tf
from eventlake.llm.queries import op2_token_files
from tests.conftest import SF001
from tests.llm.conftest import doc_frame
from tests.llm.test_bpe import TRICKY

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_query_matches_brute_force(spark, tokenizer):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op2_token_files(spark, SF001).collect()}
    start, expected = 0, {}
    for r in docs:
        ids = ids_of(tokenizer, r.text)
        expected[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == expected


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [5, 5, 9], list(range(1000)), [2**40, 2**40, 2**41],
                                    sorted(random.Random(1).choices(range(10**6), k=777)), [0, 2**33]])
def test_elias_fano_round_trip(values):
    data = tf.EliasFano.pack(np.array(values, np.uint64))
    ef = tf.EliasFano(data)
    assert ef.all().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        ef.select(len(values))


def test_elias_fano_is_near_minimal():
    rnd = random.Random(2)
    values = sorted(rnd.choices(range(1 << 20), k=1000))
    assert len(tf.EliasFano.pack(np.array(values))) * 8 < 1000 * (2 + 11) + 1000 / tf.SAMPLE * 32 + 200


def test_encoder_equals_the_library(tokenizer):
    rnd = random.Random(3)
    texts = TRICKY + ["".join(rnd.choices("ab  \n\t'.1 é東", k=rnd.randint(0, 40))) for _ in range(800)]
    encode = tf.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        got = encode(texts)
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [
            e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_other_tokenizers_are_not_cut():
    encode = tf.Encoder(P.path("word_bpe_49k.json"))
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = ["Hello  World it's", "", "a b\n c"]
    assert not encode.cuts
    assert [np.frombuffer(g, "<u2").tolist() for g in encode(texts)] == [
        e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_blocks_shards_and_random_access(spark, tokenizer, tmp_path):
    rnd = random.Random(5)
    docs = {rnd.randrange(-10**12, 10**12): " ".join(rnd.choices(["alpha", "beta", "<|endoftext|>", "x"], k=rnd.randint(0, 50)))
            for _ in range(300)}
    path = tf.write(doc_frame(spark, docs.items()).repartition(5), PATH, f"file:{tmp_path}/t", block_tokens=200)
    got = {r.doc_id: (r.start, list(r.ids)) for r in tf.read(spark, path).collect()}
    start = 0
    for i in sorted(docs):
        ids = ids_of(tokenizer, docs[i])
        assert got[i] == (start, ids)
        start += len(ids)
    row = spark.read.parquet(path).where("n_docs > 3").first().asDict()
    ends, doc_ids = tf._boundaries(row)
    for k in (0, 1, row["n_docs"] - 1):
        assert tf.document(row, k).tolist() == got[doc_ids[k]][1]


def test_edges(spark, tokenizer):
    rows = [(3, None), (None, "first"), (3, "again"), (1, ""), (2, "word " * 30_000)]
    df = doc_frame(spark, rows).withColumnRenamed("lang", "shard").withColumnRenamed("source", "ids")
    got = tf.read(spark, tf.write_to_shared(df, PATH, block_tokens=100)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert list(got[0].ids) == ids_of(tokenizer, "first") and list(got[1].ids) == [0]
    assert got[2].n_tokens == len(ids_of(tokenizer, "word " * 30_000))
    assert sorted(r.n_tokens for r in got[3:]) == sorted([1, len(ids_of(tokenizer, "again"))])
    assert tf.read(spark, tf.write_to_shared(doc_frame(spark, []), PATH)).collect() == []


def test_rows_without_an_id_are_dealt_to_several_shards(spark, tmp_path):
    rows = [(None, f"text number {i}") for i in range(300)] + [(i, f"other {i}") for i in range(30)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("false", "6")):
            spark.conf.set(k, v)
        path = tf.write(doc_frame(spark, rows), P.path("byte_bpe_50k.json"), f"file:{tmp_path}/t")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    blocks = spark.read.parquet(path).where("n_null > 0").groupBy("shard").agg({"n_null": "sum"}).collect()
    assert len(blocks) > 1 and sum(r[1] for r in blocks) == 300
    assert sum(r.doc_id is None for r in tf.checksums(spark, path).collect()) == 300
