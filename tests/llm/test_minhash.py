import hashlib
import random
import re

import numpy as np

from eventlake.llm import minhash
from eventlake.llm.queries import op5_minhash
from tests.conftest import SF001
from tests.llm.conftest import components, doc_frame


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(got, docs):
    """Rows (in id order) against the contract; likeness against the exact Jaccard similarity."""
    errors = []
    for i, r in enumerate(got):
        text, following = docs[i] or "", docs[(i + 1) % len(docs)] or ""
        n = len(text) // 4
        edited = text[:len(text) - n] + following[:n]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        lanes = lambda s: np.frombuffer(bytes(s) if not isinstance(s, str) else bytes.fromhex(s), ">u2")
        own, new = lanes(r.fingerprint), lanes(r.edited_fingerprint)
        assert own.tolist() == minhash.of_texts([text.encode()])[0].tolist()
        assert new.tolist() == minhash.of_texts([edited.encode()])[0].tolist()
        assert r.near_edited == (own == new).mean()
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, following)]
    assert np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.25
    assert abs(np.mean(errors)) < 0.01


def test_query_matches_brute_force(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()]
    check(op5_minhash(spark, SF001).orderBy("doc_id").collect(), docs)


def test_order_over_many_partitions(spark):
    rnd = random.Random(2)
    docs = {i * 3: " ".join(rnd.choices("abcdefghij", k=rnd.randint(0, 60))) for i in range(200)}
    items = list(docs.items())
    rnd.shuffle(items)
    got = minhash.edited_fingerprints(doc_frame(spark, items).repartition(7)).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == sorted(docs)
    check(got, [docs[i] for i in sorted(docs)])


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(2, None), (None, "é" * 9), (3, ""), (3, ""), (4, "one two"), (5, long), (6, "one two")]
    df = doc_frame(spark, rows).withColumnRenamed("lang", "part").withColumnRenamed("source", "fingerprint")
    got = minhash.edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[4].fingerprint == by[6].fingerprint and by[2].fingerprint == by[3].fingerprint
    assert by[2].n_chars == 0 and by[5].n_chars == len(long) and by[None].n_chars == 9
    assert by[6].edited_sha256 == hashlib.sha256(("one tw" + "é").encode()).hexdigest()  # wraps to the first row
    assert minhash.edited_fingerprints(doc_frame(spark, [])).collect() == []
    one = minhash.edited_fingerprints(doc_frame(spark, [(1, "abcdefgh")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(9)
    docs = {}
    for c in range(8):
        base = [f"c{c}w{i}" for i in range(80)]
        for _ in range(5):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):
                w[rnd.randrange(len(w))] = f"x{rnd.random()}"
            docs[len(docs)] = " ".join(w)
    docs[len(docs)] = ""
    docs[len(docs)] = None
    expected = components(list(docs), lambda a, b: jaccard(docs[a], docs[b]) >= 0.8)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(doc_frame(spark, docs.items())).collect()}
    assert got == expected


def test_near_duplicates_judges_every_text_by_itself(spark):
    words = [f"w{i}" for i in range(2000)]
    x = " ".join(words)
    for t in range(100):  # y differs in one word and has the fingerprint of x
        w = [*words[:900], f"q{t}", *words[901:]]
        y = " ".join(w)
        if (np.diff(minhash.of_texts([x.encode(), y.encode()]), axis=0) == 0).all():
            break
    else:
        raise AssertionError("no equal fingerprint")
    z = " ".join([*w[:1779], *[f"z{i}" for i in range(221)]])  # near y only
    assert jaccard(y, z) >= 0.8 > jaccard(x, z)
    other = " ".join(f"o{i}" for i in range(30))
    rows = [(1, x), (2, y), (3, z), (4, other), (4, x)]  # id 4 has two texts
    got = sorted((r.doc_id, r.class_id) for r in minhash.near_duplicates(doc_frame(spark, rows)).collect())
    assert got == [(1, 1), (2, 1), (3, 1), (4, 1), (4, 4)]
