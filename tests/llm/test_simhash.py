import random
import re

import numpy as np
import xxhash

from eventlake.llm import simhash
from eventlake.llm.queries import op7_simhash_groups
from tests.conftest import SF001
from tests.llm.conftest import components, doc_frame


def slow_fingerprint(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_matches_brute_force():
    texts = [None, "", " \t\n", "one", "One two", "a b c d", "É à b C d e F",
             " ".join(random.Random(1).choices("abcdefg", k=400)), "x\x0by\x0cz\x1cw v u t"]
    for t in texts:
        got = simhash.fingerprint((t or "").encode()) % (1 << 64)
        assert got == slow_fingerprint(t), t


def test_links_equal_brute_force_also_for_long_runs(spark):
    rnd = random.Random(7)
    centre = [rnd.getrandbits(64) for _ in range(6)]
    fps = {c for c in centre}
    for c in centre:
        for _ in range(40):
            x = c
            for b in rnd.sample(range(64), rnd.randint(1, 7)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    expected = components(fps, lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 4)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for max_run in (20_000, 3):
        edges = [(r.a, r.b) for r in simhash.links(df, 4, max_run).collect()]
        assert all(bin((a ^ b) % (1 << 64)).count("1") <= 4 for a, b in edges)
        known = set(edges) | {(b, a) for a, b in edges}
        got = components(fps, lambda a, b: (a, b) in known)
        assert got == expected


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    fps = {i: slow_fingerprint(t) for i, t in docs.items()}
    expected = components(list(docs), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 4)
    got = op7_simhash_groups(spark, SF001).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{fps[i]:016x}", expected[i]) for i in docs}


def test_edge_cases(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf today"
    rows = [(5, base), (3, base.upper()), (9, None), (4, " "), (7, "lone"), (7, "lone"), (None, base), (None, None)]
    df = doc_frame(spark, rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "fp")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_groups(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 4), (4, 4), (7, 7), (7, 7), (None, 3), (None, 4)], key=str)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["3", "4", "7", "None", "None"]
    assert simhash.simhash_groups(doc_frame(spark, [])).collect() == []


def test_different_texts_under_one_id_stay(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf today"
    others = [" ".join(f"{c}{i}" for c in "abcdefghij") for i in range(40)]
    fps = [slow_fingerprint(t) for t in [base, *others]]
    assert all(bin(a ^ b).count("1") > 4 for i, a in enumerate(fps) for b in fps[:i])
    # the text of id 7 that is kept elsewhere goes, the placeholder's others stay
    rows = [(7, base), (3, base.upper()), *[(7, t) for t in others], (7, others[0]), (9, others[1])]
    kept = simhash.drop_near_duplicates(doc_frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(3, base.upper()), *[(7, t) for t in others]])


def test_hot_copies_post_once(spark):
    rows = [(i, "same text of the copies here") for i in range(300)] + [(1000 + i, f"w{i} x{i} y{i} z{i}") for i in range(50)]
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(doc_frame(spark, rows)).collect()}
    assert all(got[i] == 0 for i in range(300))


def test_forest_is_linear():
    fps = np.arange(1, 2000, dtype=np.uint64) & np.uint64(0x7)
    a, b = simhash._forest(np.unique(fps), 4)
    assert sum(map(len, a)) == len(np.unique(fps)) - 1
