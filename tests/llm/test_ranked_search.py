import math
import random
import re
from collections import Counter

import pytest

from eventlake.llm import ranked_search
from eventlake.llm.ranked_search import contribution, length_norm, search, weight
from tests.llm.conftest import doc_frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in wanted.items():
        scores = []
        for doc_id, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in ts if t in bag)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k, r[3], -r[0]) for k, r in enumerate(sorted(scores)[:top], 1)]
    return out


def corpus(seed, n=400):
    rnd = random.Random(seed)
    common = ["the", "And", "of", "été", "東京", "x1"]
    rare = [f"w{i}" for i in range(150)]
    made = []
    for i in range(n):
        words = rnd.choices(common, k=rnd.randint(0, 12)) + rnd.choices(rare, k=rnd.randint(0, 6))
        rnd.shuffle(words)
        made.append((i, rnd.choice([" ", ", ", "-"]).join(words)))
    made += [(None, "w1 w2 the"), (None, "w1 w2 the"), (3, made[3][1]), (5, "the W1 w1"), (900, None), (901, "..."),
             (902, "été " * 5000)] + [(1000 + i, "w7 same copy of the") for i in range(120)]
    items = [(i, " ".join(rnd.choices(common + rare, k=rnd.randint(1, 9)))) for i in range(25)]
    items += [(3, "w99 w98"), (None, "THE w1"), (70, None), (71, "unknownterm"), (72, "w7 copy"), (73, "")]
    return made, items


def result(spark, docs, items, **kw):
    out = search(doc_frame(spark, docs).repartition(5), spark.createDataFrame(items, "item_id long, text string"), **kw)
    return [(r.item_id, r["rank"], r.doc_id, r.score) for r in out.collect()]


@pytest.mark.parametrize("seed,owners,shards,max_terms", [(1, 4, 64, 10**6), (2, 1, 3, 10**6), (3, 7, 5, 40)])
def test_matches_brute_force(spark, monkeypatch, seed, owners, shards, max_terms):
    monkeypatch.setattr(ranked_search, "OWNERS", owners)
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", -(-500 // shards))
    docs, items = corpus(seed)
    got = result(spark, docs, items, top=20, max_terms=max_terms)
    assert sorted(got, key=str) == sorted(brute(docs, items, 20), key=str)


def test_bundles_leave_out_only_the_hopeless(spark, monkeypatch):
    """What travels on between the owners shrinks, the result does not."""
    docs = [(i, "the of " + ("rare " if i < 3 else "") + "and " * (i % 4)) for i in range(600)]
    assert sorted(result(spark, docs, [(1, "rare the and of")], top=2)) == sorted(brute(docs, [(1, "rare the and of")], 2))


def test_edges(spark):
    assert result(spark, [], [(1, "a")]) == [] and result(spark, [(1, "a")], []) == []
    assert result(spark, [(1, ""), (2, None)], [(1, "a")]) == []
    df = doc_frame(spark, [(1, "a b"), (2, "b")]).withColumnRenamed("lang", "row").withColumnRenamed("source", "terms")
    items = spark.createDataFrame([("q", "b", 1)], "item_id string, text string, owner int")
    assert [(r.item_id, r.doc_id) for r in search(df, items).orderBy("rank").collect()] == [("q", 2), ("q", 1)]


def test_formulas():
    assert weight(10, 10) == math.floor(1000 * math.log(22 / 21))
    assert contribution(3, 70) == 3_000_000_000 // 4400 and length_norm(7, 10, 35) == 150
