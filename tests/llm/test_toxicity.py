import binascii
import random

import pytest

from eventlake.llm import toxicity
from eventlake.llm.queries import op3_toxicity
from tests.conftest import SF01
from tests.llm.conftest import doc_frame


def test_held_out_accuracy_and_fold(spark):
    got = {r.doc_id: r for r in op3_toxicity(spark, SF01).collect()}
    docs = spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert len(got) == docs
    assert all(r.held_out == (binascii.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    held = [(labels[i], r.predicted) for i, r in got.items() if i in labels and r.held_out]
    assert len(held) > 40
    assert sum(a == b for a, b in held) / len(held) >= 0.95  # 70 rows, some labelled at random


def test_swap_penalty_frees_neutral_mentions():
    rnd = random.Random(3)
    filler = [f"w{i}" for i in range(40)]
    texts, toxic = [], []
    for i in range(400):
        words = set(rnd.sample(filler, 6))
        bad = i % 2
        if bad:
            words.add("idiot")
            if rnd.random() < 0.9:
                words.add("muslims")  # the group is mentioned mostly in toxic texts
        elif rnd.random() < 0.3:
            words.add("christians")
        texts.append(words)
        toxic.append(bad)
    vocabulary = ["idiot", *filler]
    plain = toxicity.fit_weights(texts, toxic, vocabulary, fairness=0.0)
    fair = toxicity.fit_weights(texts, toxic, vocabulary, fairness=10.0)

    def gap(m):
        return abs(m.score("w1 w2 muslims live here") - m.score("w1 w2 christians live here"))

    assert gap(plain) > 0.1 and gap(fair) < 0.02
    assert fair.score("w1 w2 muslims live here") < 0.5 < fair.score("w1 idiot w2")


@pytest.mark.parametrize("labels,expected", [([], {0}), ([(1, 0, 0), (2, 0, 0)], {0}), ([(1, 0, None)], {0})])
def test_without_both_classes(spark, labels, expected):
    docs = doc_frame(spark, [(1, "a b"), (2, None), (None, "")])
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(docs, frame)
    assert kept.columns == docs.columns and kept.count() == 3


def test_edges(spark):
    rows = [(i, "you idiot scum" if i % 2 else "a fine day") for i in range(60)] + [(1, "you idiot scum"), (100, "")]
    docs = doc_frame(spark, rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "toxic")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(3, 1, 1), (None, 1, 1), (999, 0, 1), (5, 1, None)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).select("doc_id", "toxicity").collect()
    assert all((s.toxicity >= 0.5) == (s.doc_id % 2 == 1) for s in scored if s.doc_id < 60)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id % 2 for r in kept.collect()} == {0}
    assert toxicity.drop_toxic(doc_frame(spark, []), labels).count() == 0


def test_training_bound(spark):
    labels = spark.range(5000).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 as int) as toxic")
    n = toxicity.training_rows(labels, max_train=500).count()
    assert 400 < n < 600
