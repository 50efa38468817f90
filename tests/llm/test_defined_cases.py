"""Columns named like internal ones, repeated ids, hot anchors, long texts of phrases."""

import time

import pytest
from pyspark.sql import functions as F

from eventlake.llm import license_scan, mixing, simhash, substring_dedup, toxicity
from tests.llm.conftest import doc_frame

CLASHING = ("__id", "__new", "__marks", "__copy", "__source", "__cut", "__digest", "__keep", "__toxicity", "mix_size",
            "mix_copies", "dedup_kept", "DEDUP_n_removed", "plan_cut", "copy_", "marks_id", "simhash_digest",
            "toxicity_score", "a.dot")


def clashing(spark, rows):
    df = doc_frame(spark, rows)
    for c in CLASHING:
        df = df.withColumn(c, F.concat(F.lit(c + " of "), F.col("doc_id").cast("string")))
    return df


def untouched(rows):
    return all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in CLASHING)


PASSAGE = " ".join(f"shared{i}" for i in range(60))


def documents():
    return [(i, f"{' '.join(f'own{i}x{j}' for j in range(30))} {PASSAGE if i < 3 else ''}", "en", "s")
            for i in range(6)]


def labels_of(spark, rows):
    return spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows)], "doc_id long, toxic int")


@pytest.mark.parametrize("stage_of", [
    lambda df, labels: toxicity.drop_toxic(df, labels, threshold=1.1),
    lambda df, labels: simhash.drop_near_duplicates(df),
    lambda df, labels: substring_dedup.dedup_texts(df),
    lambda df, labels: mixing.take_mix(df),
], ids=["toxicity", "simhash", "substring", "mix"])
def test_columns_named_like_internal_ones(spark, stage_of):
    rows = documents()
    df = clashing(spark, rows)
    out = stage_of(df, labels_of(spark, rows))
    got = out.collect()
    assert out.columns == df.columns and {r.doc_id for r in got} == set(range(6)) and untouched(got)
    plain = doc_frame(spark, rows)
    same = stage_of(plain, labels_of(spark, rows)).select("doc_id", "text").collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted((r.doc_id, r.text) for r in same)


def test_the_row_that_stays_of_equal_ids_and_texts(spark):
    rows = [(1, "one text of some words here", "en", f"s{i}") for i in range(20)]
    kept = {tuple(simhash.drop_near_duplicates(doc_frame(spark, rows[k:] + rows[:k]).repartition(n)).collect()[0])
            for k, n in ((0, 1), (7, 5), (13, 3))}
    assert len(kept) == 1


def test_the_text_that_trains_of_several_under_one_id(spark):
    rows = [(i, f"text {k} of words " + ("bad " if i % 2 else "fine ") * (k + 1), None, None)
            for i in range(60) for k in range(3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    texts = doc_frame(spark, [(900, "bad text of words"), (901, "fine text 2")])
    scores = {tuple(r.toxicity for r in toxicity.score(
        texts, toxicity.fit(doc_frame(spark, rows[::step]).repartition(n), labels)).orderBy("doc_id").collect())
        for step, n in ((1, 1), (-1, 4), (1, 7))}
    assert len(scores) == 1


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_hot_anchors_lose_nothing(spark, monkeypatch, share):
    def removed():
        df = doc_frame(spark, [(i, f"w{i} " + PASSAGE + f" e{i}") for i in range(40)] + documents()[:4])
        return sorted((r.doc_id, r.dedup_n_removed) for r in substring_dedup.remove_repeats(df).collect())

    expected = removed()
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", share)
    assert removed() == expected and sum(n for _, n in expected) > 60 * 38


def test_texts_of_phrases_take_time_linear_in_their_length():
    scanner = license_scan.Scanner()

    def seconds(n):
        start = time.process_time()
        out = scanner.scan(b"cc by " * n)
        assert out[:4] == (2 * n, n, 0, 2 * n - 2)
        return time.process_time() - start

    seconds(1000)
    assert seconds(80_000) < 4 * 2 * max(seconds(40_000), 0.05)  # quadratic would be 4 x, and 20 s and more


def test_spans_beyond_ascii():
    text = "é mozila public license version ü mozilla publik license version".encode()
    spans = license_scan.Scanner().scan(text)[7]
    assert [(s["first_word"], s["n_words"], s["edits"]) for s in spans if s["label"] == "mpl"] == [(1, 4, 1), (6, 4, 1)]
