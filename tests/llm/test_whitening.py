import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import whitening
from eventlake.llm.queries import op13_whitening
from tests.conftest import SF001


def integers(vectors):
    return [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]


def brute(vectors, k):
    """Deviations (exact), |whitened|, explained by one numpy eigh."""
    x = integers(vectors)
    n, s = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * c - t) ** 2 for c, t in zip(row, s)) for row in x]
    centred = np.array(x, float) - np.array(s) / n
    v = centred.T @ centred / n
    values, vecs = np.linalg.eigh(v)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    return dev, np.abs(centred @ vecs / np.sqrt(values)), values / np.trace(v)


def test_query(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    dev, white, share = brute([r.embedding for r in rows], 8)
    at = {r.vec_id: i for i, r in enumerate(rows)}
    got = op13_whitening(spark, SF001).collect()
    assert len(got) == 8 * len(rows)
    for r in got:
        i, c = at[r.vec_id], r.component - 1
        assert r.n == len(rows) and r.deviation == dev[i]
        assert abs(abs(r.whitened) - white[i, c]) < 1e-6 and abs(r.explained / share[c] - 1) < 1e-9
        assert 0 <= r.identity_error < 1e-9
    sign = {}
    x = np.array(integers([r.embedding for r in rows]), float)
    for r in got:
        sign.setdefault(r.component, []).append((at[r.vec_id], r.whitened))
    for c, pairs in sign.items():  # one sign for all rows: the component is a linear map of x
        i, w = map(np.array, zip(*sorted(pairs)))
        fit = np.linalg.lstsq(x[i] - x.mean(0), w, rcond=None)[0]
        assert np.abs((x[i] - x.mean(0)) @ fit - w).max() < 1e-6


@pytest.mark.parametrize("block", [2, 7, 4096])
def test_blocks_and_invalid_rows(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    rnd = np.random.default_rng(3)
    good = rnd.normal(size=(60, 5)).round(4).tolist()
    bad = [None, [], [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [1.0, float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [1e30] * 5]
    rows = [(i, v) for i, v in enumerate(good)] + [(None, good[0]), (7, good[7])] + [(100 + i, v) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumn("x", F.lit(1)).withColumn("index", F.lit(2))
    got = whitening.whiten(df.repartition(4), components=3, vector="v").collect()
    kept = [(i, v) for i, v in rows if v in good]
    dev, white, share = brute([v for _, v in kept], 3)
    assert len(got) == len(kept) == 62
    want = sorted((str(i), d, tuple(np.round(w, 5))) for (i, _), d, w in zip(kept, dev, white))
    assert sorted((str(r.vec_id), r.deviation, tuple(np.round(np.abs(r.whitened), 5))) for r in got) == want
    assert np.allclose(got[0].explained, share) and all(r.n == 62 and r.identity_error < 1e-6 for r in got)


def test_edges(spark):
    one = lambda rows: whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert one([]) == [] and one([(1, None), (2, [])]) == []
    got = one([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0])])  # no variance at all
    assert len(got) == 3 and all(r.whitened == [0.0, 0.0] and r.identity_error == 0.0 and r.deviation == 0 for r in got)
    got = one([(1, [1.0, 0.0]), (2, [3.0, 0.0])])
    assert all(abs(abs(r.whitened[0]) - 1) < 1e-9 and r.whitened[1] == 0.0 for r in got)


def test_exact_deviation_beyond_longs(spark):
    rows = [(i, [float(2 ** 45 + i * 2 ** 40), -float(i)]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = integers([v for _, v in rows])
    s = [sum(c) for c in zip(*x)]
    assert {r.vec_id: int(r.deviation) for r in got} == {
        i: sum((9 * c - t) ** 2 for c, t in zip(x[i], s)) for i in range(9)}
