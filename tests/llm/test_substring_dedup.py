import hashlib
import random
import re

import numpy as np
import pytest

from eventlake.llm import substring_dedup as sd
from eventlake.llm.queries import op9_substring_dedup
from tests.conftest import SF001
from tests.llm.conftest import doc_frame


def brute(docs, window):
    """{doc_id: (n_words, n_removed, kept)}"""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs.items()}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p:p + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out[i] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return out


def result(df, **kw):
    return {r.doc_id: (r.dedup_n_words, r.dedup_n_removed, r.dedup_kept) for r in sd.remove_repeats(df, **kw).collect()}


@pytest.mark.parametrize("seed,window,anchor", [(1, 50, 16), (2, 50, 16), (3, 12, 4), (4, 6, 1), (5, 8, 8)])
def test_matches_brute_force(spark, seed, window, anchor):
    rnd = random.Random(seed)
    lexicon = [f"w{i}" for i in range(rnd.choice([3, 30, 3000]))]
    passages = [rnd.choices(lexicon, k=rnd.randint(window - 3, 3 * window)) for _ in range(6)]
    docs = {}
    for i in range(60):
        w = rnd.choices(lexicon, k=rnd.randint(0, 2 * window))
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            lo = rnd.randint(0, 5)
            at = rnd.randint(0, len(w))
            w[at:at] = p[lo:len(p) - rnd.randint(0, 5)]
        if i % 7 == 0 and docs:
            w = docs[rnd.choice(list(docs))].split()
            if w and rnd.random() < 0.7:
                w[rnd.randrange(len(w))] = "edited"
        docs[rnd.randrange(10_000)] = rnd.choice([" ", "\n", " \t "]).join(w)
    df = doc_frame(spark, docs.items())
    assert result(df, window=window, anchor=anchor) == brute(docs, window)


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op9_substring_dedup(spark, SF001).collect()}
    assert got == {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in brute(docs, 50).items()}


def test_edges(spark):
    long = " ".join(f"t{i % 977}" for i in range(30_000))
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, None), (1, None), (2, ""), (3, passage), (4, "x " + passage + " y"), (4, "x " + passage + " y"),
            (None, passage), (5, long), (6, long + " end"), (7, "\u00a0".join(passage.split()))]
    df = doc_frame(spark, rows).withColumnRenamed("lang", "run").withColumnRenamed("source", "marks")
    got = sorted(((r.doc_id, r.dedup_n_words, r.dedup_n_removed) for r in sd.remove_repeats(df).collect()), key=str)
    assert got == sorted([(1, 0, 0), (1, 0, 0), (2, 0, 0), (3, 50, 0), (4, 52, 50), (4, 52, 50), (None, 50, 0),
                          (5, 30_000, 0), (6, 30_001, 30_000), (7, 1, 0)], key=str)
    texts = sd.dedup_texts(df)
    assert texts.columns == df.columns
    kept = {(r.doc_id, r.text, r.n_chars) for r in texts.collect()}
    assert (4, "x y", 3) in kept and (3, passage, len(passage)) in kept and (None, passage, len(passage)) in kept
    assert sd.remove_repeats(doc_frame(spark, [])).collect() == []


def test_rows_that_share_an_id_but_not_the_text(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, passage), (2, "a b c " + passage), (2, "short"), (2, " ".join(f"q{i}" for i in range(80)))]
    got = sorted(r.dedup_n_removed for r in sd.remove_repeats(doc_frame(spark, rows)).collect())
    assert got == [0, 0, 0, 60]


def test_chunks_do_not_change_the_result(monkeypatch):
    h = np.random.default_rng(0).integers(0, 50, 500).astype(np.uint64)
    rows = np.array([0, 120, 500])
    whole = sd.runs_of(h, rows, 20, 8)
    monkeypatch.setattr(sd, "CHUNK", 64)
    cut = sd.runs_of(h, rows, 20, 8)
    assert cut[2].sum() == whole[2].sum()  # the same windows
    flat = lambda r: {(d, s + j, a) for d, s, c, a in zip(r[0], r[1], r[2], r[4]) for j in range(c)}
    assert flat(whole) == flat(cut)


def test_leftmost_minimum():
    rnd = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 35):
        v = rnd.integers(0, 9, 200).astype(np.uint64)
        got = sd.leftmost_minimum(v, width)
        assert got.tolist() == [i + int(np.argmin(v[i:i + width])) for i in range(len(v) - width + 1)]
