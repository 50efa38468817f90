import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from eventlake.llm import bpe
from eventlake.llm.queries import op10_bpe
from tests.conftest import SF001
from tests.llm.conftest import doc_frame

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})

TRICKY = ["", " ", "  ", "\n", " \n ", "a  b   c", "tab\t\tx  y  z", "it's we'll I'M", "x  y 　z", "\x1c a\x1cb \x1c c",
          "<|endoftext|> is text", "déjà vu 東京タワーへようこそ 123 4567", "👩‍👩‍👧 emoji", " lead and trail ", "a\r\n b\n\n  c",
          "x" * 300, "ab" * 200 + " " + "東" * 120, "\u0085x \u0085 y", "don''t!!!   ???", "a \n\n b \t c", "1 2  33   4"]


def test_query_matches_the_library(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = op10_bpe(spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = REFERENCE.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


@pytest.mark.parametrize("hot", [0, 5, 400_000])
def test_tricky_texts_and_round_trip(spark, hot):
    rnd = random.Random(4)
    alphabet = "ab e\n\t  éß東'.,!12 "
    texts = TRICKY + ["".join(rnd.choices(alphabet, k=rnd.randint(1, 60))) for _ in range(300)]
    out = bpe.decode(bpe.encode(doc_frame(spark, list(enumerate(texts))), RANKS, P.PATTERN, hot_words=hot), RANKS)
    got = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == REFERENCE.encode_ordinary(t), repr(t)
        assert bytes(got[i].decoded) == t.encode()


def test_words_of_any_length(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefgh", k=n)) for n in (1, 2, 3, 10, 63, 64, 65, 200)] + ["e" * 500, "é" * 40]
    words += ["".join(rnd.choices("etaoin", k=rnd.randint(1, 30))) for _ in range(200)]
    df = spark.createDataFrame([(w.encode(),) for w in words], "w binary")
    for r in df.select("w", bpe.encode_words(F.array("w"), RANKS)[0].alias("ids")).collect():
        assert r.ids == REFERENCE._encode_single_piece(bytes(r.w))


def test_chunks_never_cut_a_word():
    find = regex.compile(P.PATTERN.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")).findall
    rnd = random.Random(6)
    texts = TRICKY + ["".join(rnd.choices("ab  \n\t'.1 ", k=rnd.randint(1, 30))) for _ in range(3000)]
    for t in texts:
        parts = bpe.chunks(t)
        assert "".join(parts) == t
        assert [w for p in parts for w in find(p)] == find(t), repr(t)


def test_edges(spark):
    rows = [(1, None), (1, None), (None, "a b"), (2, ""), (3, "word " * 20_000)]
    df = doc_frame(spark, rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "seqs")
    got = sorted(((r.doc_id, len(r.ids)) for r in bpe.encode(df, RANKS, P.PATTERN).collect()), key=str)
    assert got == sorted([(1, 0), (1, 0), (None, 2), (2, 0), (3, 20_001)], key=str)
    assert bpe.encode(doc_frame(spark, []), RANKS, P.PATTERN).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {(r.doc_id, r.decoded if r.decoded is None else bytes(r.decoded)) for r in bpe.decode(nothing, RANKS).collect()} == {
        (1, None), (2, b"")}


def test_hot_words_are_cut_without_one_task_of_all_words(spark, monkeypatch):
    plans, whole = {}, bpe.stage

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return whole(df, name)

    monkeypatch.setattr(bpe, "stage", kept)
    words = ["a"] * 9 + ["b"] * 7 + ["c", "d", "e", "f"] * 3 + ["g", "h"]
    docs = doc_frame(spark, [(i, w) for i, w in enumerate(words)])
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    for size, ordered in ((2, False), (4, True), (6, False), (50, False)):
        got = bpe.hot_dictionary(docs, ranks, P.PATTERN, size)[0]
        assert sorted(got) == [w.encode() for w in "abcdefgh"[:size]]
        # only a part of the words at the cut is ever put in order
        assert ("TakeOrderedAndProject" in plans["bpe_hot"]) == ordered and "bpe_counts" in plans


def test_long_white_space_and_broken_bytes(spark):
    """Spaces before white space of several bytes are no cuts; bytes that are not UTF-8 read as the replacement character."""
    rnd = random.Random(11)
    for _ in range(2000):
        t = "".join(rnd.choices(["a", " ", " ", " ", "　", " ", "¿q", "“x”", "あ", "\x1c", "\n"], k=12))
        assert "".join(bpe.chunks(t)) == t
        parts = [w for p in bpe.chunks(t) for w in bpe.splitter(P.PATTERN)(p)]
        assert parts == bpe.splitter(P.PATTERN)(t), repr(t)
    df = spark.sql("SELECT 1L AS doc_id, cast(X'61FF206220C362' AS string) AS text")
    got = bpe.encode(df, RANKS, P.PATTERN).collect()[0].ids
    assert got == REFERENCE.encode_ordinary(b"a\xff b \xc3b".decode("utf-8", "replace"))


def test_pieces_that_merges_do_not_reach():
    """Such a piece is a token as a whole word only, as in the library."""
    ranks = {bytes([i]): i for i in range(256)}
    ranks |= {b"ab": 256, b"abcd": 257, b"bc": 258}
    assert bpe.merges(ranks) == {b"ab": (b"a", b"b"), b"abcd": None, b"bc": (b"b", b"c")}
    with pytest.raises(ValueError):
        bpe.rank_table({b"x": bpe.PAIR}, {})


def test_a_pattern_with_gaps(spark):
    docs = doc_frame(spark, [(1, "ab, cd  ef!"), (2, "gh")])
    got = {r.doc_id: r.ids for r in bpe.encode(docs, RANKS, r" ?\p{L}+").collect()}
    assert got == {1: [i for w in ("ab", " cd", " ef") for i in REFERENCE.encode_ordinary(w)],
                   2: REFERENCE.encode_ordinary("gh")}


@pytest.mark.parametrize("kept", [1, 3, 10**6])
def test_words_are_shared_between_the_blocks_of_a_task(spark, monkeypatch, kept):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 100)
    monkeypatch.setattr(bpe, "KEPT_WORDS", kept)
    rnd = random.Random(21)
    vocabulary = [f"{rnd.choice('abcdefgh')}{rnd.randint(0, 60)}x" for _ in range(90)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 15))) for _ in range(200)]
    got = bpe.encode(doc_frame(spark, list(enumerate(texts))).coalesce(2), RANKS, P.PATTERN, hot_words=5).collect()
    assert {r.doc_id: r.ids for r in got} == {i: REFERENCE.encode_ordinary(t) for i, t in enumerate(texts)}


def test_rank_table_has_every_merge_and_no_other():
    made = bpe.merges(RANKS)
    table = bpe.rank_table(RANKS, made)
    merged = {(RANKS[two[0]], RANKS[two[1]]): RANKS[piece] for piece, two in made.items() if two}

    def found(left, right):
        at = table["bases"][left] + right
        entry = int(table["slots"][at]) if at < len(table["slots"]) else -1
        return entry % bpe.PAIR if entry // bpe.PAIR == left else None

    assert all(found(*pair) == rank for pair, rank in merged.items())
    rnd = random.Random(5)
    n = len(table["bases"])
    for pair in [(rnd.randrange(n), rnd.randrange(n)) for _ in range(100_000)] + [(i, i) for i in range(n)]:
        assert found(*pair) == merged.get(pair)
    top = bpe.PAIR_BITS + bpe.PLACE_BITS
    for a, b in [(a, b) for a in range(256) for b in range(256)]:
        entry = int(table["firsts"][a * 257 + b])
        assert entry % bpe.PAIR == RANKS[bytes([a])]
        assert entry >> top == merged.get((RANKS[bytes([a])], RANKS[bytes([b])]), bpe.NONE)


def test_plans_do_not_hold_the_rank_table(spark):
    """Plans go into events and the driver keeps their text; the table travels as a broadcast row."""
    docs = doc_frame(spark, [(1, "plans stay small"), (2, "whatever the vocabulary")])
    plan = bpe.encode(docs, RANKS, P.PATTERN)._jdf.queryExecution()
    assert len(plan.toString()) < 50_000
