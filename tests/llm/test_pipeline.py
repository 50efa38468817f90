import re

import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from eventlake.llm import bpe, toxicity
from tests.conftest import SF001
from tests.llm.conftest import components
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_simhash import slow_fingerprint
from tests.llm.test_substring_dedup import brute as without_repeats

DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "substring_dedup", "mix_sources", "bpe"]


@pytest.fixture(scope="module")
def steps(spark):
    """The output of every stage, each from its predecessor's written output."""
    docs, out = spark.read.parquet(f"{SF001}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(f(spark, docs, SF001), f"test_{name}")
        out.append(docs)
    return out


def test_each_stage_matches_brute_force(spark, steps):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert all(s.columns == DOCS for s in steps[:-1])
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    clean = {i: r for i, r in rows.items() if model.score(r.text) < 0.5}
    assert {r.doc_id: r for r in steps[0].collect()} == clean
    fps = {i: slow_fingerprint(r.text) for i, r in clean.items()}
    groups = components(list(fps), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 4)
    kept = {i: r for i, r in clean.items() if groups[i] == i}
    assert {r.doc_id: r for r in steps[1].collect()} == kept
    left = without_repeats({i: r.text for i, r in kept.items()}, 50)
    third = {r.doc_id: r for r in steps[2].collect()}
    assert set(third) == set(kept)
    for i, r in third.items():
        assert r.text == (left[i][2] if left[i][1] else kept[i].text) and r.n_chars == len(r.text)
    plan = {i: copies for i, _, _, _, copies in mixed([(i, r.text, r.source) for i, r in third.items()])}
    fourth = steps[3].collect()
    for i, n in plan.items():
        assert [r for r in fourth if r.doc_id == i] == [third[i]] * n
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted((r.doc_id, library.encode_ordinary(r.text)) for r in fourth)
    assert sorted((r.doc_id, list(r.ids)) for r in steps[4].collect()) == expected


def test_bpe_stage_decodes_its_ids(steps):
    """The ids of every document of the mix are decoded again, to the text that the mix took."""
    assert steps[4].columns == ["doc_id", "ids", "decoded"]
    taken = sorted((r.doc_id, (r.text or "").encode()) for r in steps[3].collect())
    assert sorted((r.doc_id, bytes(r.decoded)) for r in steps[4].collect()) == taken


def test_run_equals_the_stages(spark, steps):
    got = entry.queries()["pipeline"](spark, SF001)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1].collect()))


def test_empty_table_runs_through(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(0).write.parquet(f"file:{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, f"file:{tmp_path}").collect() == []


def test_registered_names():
    names = [k for k in entry.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert {"op6_source_mix", "op9_substring_dedup", "op12_ranked_search"} <= set(entry.oracle_sql())
