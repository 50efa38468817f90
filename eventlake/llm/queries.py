"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (bpe, embedding_dedup, license_scan, minhash, mixing, ranked_search, sharding, simhash,
                           substring_dedup, token_files, toxicity, url_filter, whitening)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow",
             "com/de/": "block"}


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: by rule, else by boosted trees trained on the urls that have one."""
    return url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


TOKENIZER_FILE = "byte_bpe_50k.json"


def op2_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Token files of every whole document, written and read back: place, length and checksum of its ids."""
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = token_files.write_to_shared(docs, tokenizer or public_tokenizers.path(TOKENIZER_FILE))
    return token_files.checksums(spark, path)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, column="score")
    return scored.select("doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and edited notices in every document, with the notices' spans."""
    return license_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash fingerprints of every document and of its edited copy."""
    out = minhash.edited_fingerprints(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
                      F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix over all documents: each document's size and the words taken."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.round("mix_target", 6).alias("target"),
                        (F.col("mix_copies") * F.col("mix_size")).cast("long").alias("taken"))


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(length(text), 0) AS n
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)::DOUBLE + 0.5)
             / 4503599627370496.0)
         / ((CASE WHEN n / greatest(size, 1) BETWEEN 3 AND 12 THEN 1.0::DOUBLE ELSE 0.25 END)
            * (CASE WHEN size >= 50 THEN 1.0::DOUBLE ELSE 0.5 END)) AS draw
  FROM sized),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
weighed AS (
  SELECT *, (1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)::DOUBLE AS w,
         3.0::DOUBLE * source_size AS lim
  FROM src),
filled AS (
  SELECT *,
    ((SELECT sum(source_size) FROM weighed)::DOUBLE - (sum(lim) OVER o - lim))
      / ((SELECT sum(w) FROM weighed) - (sum(w) OVER o - w)) AS lvl
  FROM weighed
  WINDOW o AS (ORDER BY lim / w, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)),
targets AS (
  SELECT source, source_size,
         greatest(least(lim, coalesce(w * (SELECT max(lvl) FROM filled WHERE lvl <= lim / w), lim)), 0.0) AS target
  FROM filled),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
ranked AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.draw) AS upto,
         sum(k.size) OVER (PARTITION BY k.source, k.draw) AS peers
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST((epochs + CASE WHEN rest > 0 AND upto - peers / 2.0 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM ranked
"""


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate groups of all documents (4-word shingles, 4 bits)."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = simhash.simhash_groups(docs, shingle=4, max_bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links (cosine >= 0.9) and groups of all embeddings."""
    return embedding_dedup.embedding_groups(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"),
                                            cosine=0.9)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 50-word passages."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.remove_repeats(docs, window=50)
    return out.select("doc_id", F.col("dedup_n_words").alias("n_words"), F.col("dedup_n_removed").alias("n_removed"),
                      F.sha2("dedup_kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
starts AS (
  SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h
  FROM w, unnest(range(1, len(ws) - 48)) AS u(i)),
least AS (SELECT h, min(doc_id) AS first_doc FROM starts GROUP BY h),
gone AS (
  SELECT s.doc_id, s.i FROM starts s JOIN least l USING (h) WHERE l.first_doc < s.doc_id),
cover AS (
  SELECT DISTINCT doc_id, i + j AS pos FROM gone, unnest(range(0, 50)) AS u(j)),
lost AS (SELECT doc_id, list(pos) AS ps FROM cover GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws
              ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id)
"""


BPE_FILE = "byte_bpe_50k.tiktoken"


def op10_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Token ids of every whole document and the bytes they decode to, as digests."""
    import public_tokenizers

    ranks = bpe.read_ranks(ranks_path or public_tokenizers.path(BPE_FILE))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards by a two-pass external shuffle."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shuffle_shards(docs, shards=8)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return out.select("doc_id", F.col("shard_size").alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"),
                      F.col("shard_no").alias("shard"), F.col("shard_slot").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked_search.search(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                _table(spark, sf_dir, "benchmark").select("item_id", "text"), top=50)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
full_ AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM full_),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
tf AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(ts) AS term FROM full_) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, corpus),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM full_, corpus),
scored AS (
  SELECT q.item_id, m.r, m.doc_id,
         CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * m.m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m ON m.r = tf.r
  GROUP BY q.item_id, m.r, m.doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 8 whitened components of every embedding, a row per component."""
    out = whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=8)
    out = out.select("vec_id", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "identity_error",
                     F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "of.whitened", "of.explained",
                      "identity_error")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus pipeline (``corpus_pipeline.run``)."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_token_files": op2_token_files,
    "op3_toxicity": op3_toxicity,
    "op4_license_scan": op4_license_scan,
    "op5_minhash": op5_minhash,
    "op6_source_mix": op6_source_mix,
    "op7_simhash_groups": op7_simhash_groups,
    "op8_embedding_groups": op8_embedding_groups,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_bpe": op10_bpe,
    "op11_sharding": op11_sharding,
    "op12_ranked_search": op12_ranked_search,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}
SQL: dict[str, str] = {"op6_source_mix": OP6_SQL, "op9_substring_dedup": OP9_SQL, "op12_ranked_search": OP12_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return {**SQL, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
