"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read again as the next stage's
docs, so a lost executor costs at most one stage.

1. toxicity: documents that the classifier rejects go; it learns from the
   labels of sf_dir outside the held-out fold.
2. simhash_dedup: one document of each SimHash group stays (the smallest id).
3. substring_dedup: words in 50-word windows that start in a document with a
   smaller id go; the rest stays in place.
4. mix_sources: each document as often as the mix takes it (0 to 3 times).
5. bpe: the token ids of every whole text, and the bytes they decode to.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from eventlake.llm import bpe, mixing, simhash, toxicity  # noqa: E402
from eventlake.llm import substring_dedup as substrings  # noqa: E402
from eventlake.llm.queries import BPE_FILE  # noqa: E402
from eventlake.llm.shared import stage  # noqa: E402
from eventlake.session import use_scratch_folder  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score under 0.5."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.drop_toxic(docs, labels)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """One document of each SimHash group (4-word shingles, at most 4 bits apart)."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Texts without the passages of 50 words and more that an earlier document has."""
    return substrings.dedup_texts(docs, window=50)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Each document as often as the mix takes it."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """(doc_id, ids, decoded): the token ids of every text of the mix, and the bytes they decode to."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(BPE_FILE))
    # written between the two, so that a task never holds the Python workers of both
    ids = stage(bpe.encode(docs, ranks, public_tokenizers.PATTERN), "pipeline_ids")
    return bpe.decode(ids, ranks)


def _stage(fn):
    """``fn`` in a session that has a folder for intermediate tables."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        use_scratch_folder(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("toxicity", _stage(drop_toxic)),
    ("simhash_dedup", _stage(simhash_dedup)),
    ("substring_dedup", _stage(substring_dedup)),
    ("mix_sources", _stage(mix_sources)),
    ("bpe", _stage(encode)),
]

ORACLE_SQL = None  # the classifier and the tokenizer have no SQL form; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    use_scratch_folder(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage_fn in STAGES[:-1]:
        docs = stage(stage_fn(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
