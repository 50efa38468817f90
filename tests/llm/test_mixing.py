import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventlake.llm import mixing
from tests.llm.conftest import doc_frame


def targets_by_resharing(sizes, cap=3.0):
    """{source: target}: shares by weight, the excess over the cap shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: 1.0 + i % 3 for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        total = sum(w[s] for s in open_)
        share = {s: left * w[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


def brute(rows):
    """[(doc_id, size, source_size, target, copies)] of (doc_id, text, source) rows."""
    made = []
    for i, t, s in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        u = (int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13
        mean = len(t or "") / max(size, 1)
        weight = (1.0 if 3 <= mean <= 12 else 0.25) * (1.0 if size >= 50 else 0.5)
        made.append((i, size, s, -math.log(u) / weight))
    sizes = defaultdict(int)
    for _, n, s, _ in made:
        sizes[s] += n
    target = targets_by_resharing(sizes)
    out = []
    for i, n, s, key in made:
        epochs = math.floor(target[s] / sizes[s] + 1e-12) if sizes[s] else 0
        rest = target[s] - epochs * sizes[s]
        peers = sum(m for _, m, z, k in made if z == s and k == key)
        upto = sum(m for _, m, z, k in made if z == s and k <= key)
        out.append((i, n, sizes[s], round(target[s], 4), epochs + (rest > 1e-9 and upto - peers / 2 <= rest)))
    return out


def result(df, **kw):
    return [(r.doc_id, r.mix_size, r.mix_source_size, round(r.mix_target, 4), r.mix_copies)
            for r in mixing.mix(df, **kw).collect()]


@pytest.mark.parametrize("seed,bins", [(1, 4096), (2, 4096), (3, 2), (4, 1)])
def test_matches_brute_force(spark, monkeypatch, seed, bins):
    monkeypatch.setattr(mixing, "BINS", bins)
    rnd = random.Random(seed)
    names = ["b", "a", "é", "Z", None, "tiny", "zz"]
    rows = []
    for i in range(150):
        s = rnd.choice(names[:5]) if i > 2 else "tiny"
        rows.append((i, rnd.choice([None, "", "short one", " ".join(["word"] * rnd.randint(1, 120))]), s))
    rows += [(7, rows[7][1], rows[7][2]), (None, "no id here", "a"), (500, "", "zz")]
    df = doc_frame(spark, [(i, t, None, s) for i, t, s in rows]).repartition(3)
    assert sorted(result(df), key=str) == sorted(brute(rows), key=str)


def test_taken_comes_near_the_target(spark):
    rnd = random.Random(8)
    rows = [(i, "w " * rnd.randint(1, 60), None, f"s{int(rnd.random() ** 2 * 6)}") for i in range(2000)]
    got = mixing.mix(doc_frame(spark, rows)).groupBy("source").agg(
        F.sum(F.col("mix_copies") * F.col("mix_size")).alias("taken"), F.first("mix_target").alias("target"),
        F.max("mix_copies").alias("most"), F.max("mix_size").alias("largest")).collect()
    for r in got:
        assert abs(r.taken - r.target) <= r.largest and r.most <= 3


def test_quality_weights_order_the_sample(spark):
    rows = [(i, "w " * 20, None, "big" if i < 3000 else "small") for i in range(3300)]
    df = doc_frame(spark, rows)
    good = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = mixing.mix(df, weight=good).where("source = 'big'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(
        F.sum("mix_copies").alias("n")).collect()
    n = {r.odd: r.n for r in got}
    assert 0 < n[1] < n[0]


def test_take_mix_and_edges(spark):
    rows = [(1, "a b", None, "x"), (2, None, None, "y"), (2, None, None, "y"), (None, "c " * 1000, None, None)]
    df = doc_frame(spark, rows).withColumnRenamed("lang", "copies").withColumnRenamed("n_chars", "target")
    taken = mixing.take_mix(df)
    assert taken.columns == df.columns
    counts = {r.doc_id: r["count"] for r in taken.groupBy("doc_id").count().collect()}
    assert counts.get(1, 0) <= 3 and counts.get(None, 0) <= 3
    assert mixing.mix(doc_frame(spark, [])).collect() == []
    assert all(r[4] == 0 for r in result(doc_frame(spark, [(1, "", None, "x"), (2, None, None, None)])))
    with pytest.raises(ValueError):
        mixing.mix(df.withColumn("mix_size", F.lit(1)))


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(doc_frame(spark, [(1, "a b", None, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
