import math

import numpy as np
import pytest

from eventlake.llm import embedding_dedup as ed
from eventlake.llm.queries import op8_embedding_groups
from tests.conftest import SF01
from tests.llm.conftest import components


def brute(vectors):
    """{row: (links, smallest row reachable)} by all cosines in double precision."""
    unit = {}
    for i, v in enumerate(vectors):
        a = np.array(v if v else [0.0], dtype=float)
        if v and not any(x is None for x in v) and np.isfinite(a).all() and np.linalg.norm(a) > 0:
            unit[i] = a / np.linalg.norm(a)

    def linked(i, j):
        return i in unit and j in unit and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9

    n = range(len(vectors))
    comp = components(list(n), linked)
    return {i: (sum(linked(i, j) for j in n if j != i), comp[i]) for i in n}


def clustered(seed=5, n=60, dim=16):
    rnd = np.random.default_rng(seed)
    out = [v.tolist() for v in rnd.standard_normal((n, dim))]
    for c in range(4):
        centre = rnd.standard_normal(dim)
        out += [(centre * rnd.uniform(0.5, 2) + rnd.standard_normal(dim) * s).tolist() for s in (0.05, 0.1, 0.1, 0.3, 0.3)]
    return out + [out[-1], out[-1], [x * 3 for x in out[-2]]]


@pytest.mark.parametrize("block", [1024, 3])
def test_matches_brute_force_also_in_blocks(spark, block):
    vectors = clustered()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in ed.embedding_groups(df, tables=40, projections=4, block=block).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in brute(vectors).items()}


def test_query_recall_and_precision(spark):
    rows = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()}
    ids = sorted(rows)
    expected = brute([rows[i] for i in ids])
    got = {r.vec_id: r for r in op8_embedding_groups(spark, SF01).collect()}
    assert sorted(got) == ids
    true = sum(n for n, _ in expected.values())
    assert sum(r.n_links for r in got.values()) >= 0.9 * true
    assert all(got[ids[i]].n_links <= n for i, (n, _) in expected.items())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_of_the_defaults():
    assert ed.expected_recall(0.9) > 0.98 and ed.expected_recall(0.95) > 0.999
    rnd = np.random.default_rng(1)
    hit, pairs = 0, 0
    for _ in range(200):
        a = rnd.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rnd.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        v = np.array([a, 0.9 * a + math.sqrt(1 - 0.81) * b])
        k = ed.bucket_keys(v, ed.TABLES, ed.PROJECTIONS, ed.WIDTH, ed.SEED)
        hit += (k[0] == k[1]).any()
        pairs += 1
    assert hit / pairs >= 0.95


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [1.0, None]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1e299]), (11, [-0.0, 1.0]), (12, [0.0, 1.0]),
            (13, [1e-300, 0.0]), (2, [2.0, 0.0]), (None, [0.0, 3.0])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows],
                               "vec_id long, embedding array<double>, n_links int, component_id int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.embedding_groups(df).collect()), key=str)
    lone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    one = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (10, 4, 1, False), (13, 4, 1, False)]
    two = [(11, 2, 11, True), (12, 2, 11, False), (None, 2, None, False)]
    assert got == sorted(lone + one + two, key=str)
    assert ed.embedding_groups(df.limit(0)).collect() == []
