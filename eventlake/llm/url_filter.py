"""URL filter: rules first, gradient-boosted trees for the rest.

A rule is a host and the beginning of a path (``example.org/es/``). It fits its
host and all subdomains if the URL's path starts with the rule's; the longest
rule wins (of equally long ones the first by code point).

URLs without a rule are judged by gradient-boosted trees on lexical features:
lengths, path depth, digit ratio, character entropy, parameter counts, host
labels, and statistics of the host's suffixes (share of blocked URLs and number
of URLs per last label and per last two labels). The training labels are the
verdicts of the rules themselves, or any labelled URLs given.

Scale: suffix statistics are counted over all labelled URLs with partial
aggregates, and joined back as a broadcast only under a measured bound. The
trees are fitted on at most ``MAX_TRAIN`` different labelled URLs, weighted by their copies (chosen by a hash of
the URL; documented bound); scoring is one pass. So that a training row does
not see its own label, its suffix statistics leave out the fold of its host.

Defined cases: a null URL or one without ``://`` has an empty host and path
and is judged by the method; with labels of one kind, or none, everything
without a rule is allowed; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import ascii_lower, quoted, stage, stage_counted
from eventlake.operators.joins import join_group_stats

MAX_TRAIN = 20_000
FOLDS = 5
SMOOTHING = 10.0
TREES, DEPTH = 20, 4
MAX_SUFFIXES_TO_BROADCAST = 500_000

LEXICAL = ("url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "n_parameters",
           "query_length", "n_labels", "longest_label", "n_hyphens", "has_fragment")
SUFFIX = ("suffix1_share", "suffix1_log_n", "suffix2_share", "suffix2_log_n")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. ``rules`` maps rules to verdicts (a short list)."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):  # the last one tested first
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _lexical(url: str) -> tuple:
    rest = url.partition("://")[2] or url
    head = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:head].lower(), rest[head:]
    tail, hash_, _ = tail.partition("#")
    path, _, query = tail.partition("?")
    n = max(len(url), 1)
    counts = np.unique(np.frombuffer(url.encode("utf-8", "replace"), np.uint8), return_counts=True)[1]
    share = counts / max(counts.sum(), 1)
    labels = host.split(".")
    return (len(url), len(host), len(path), path.count("/"), sum(c.isdigit() for c in url) / n,
            float(-(share * np.log2(share)).sum()) if len(share) else 0.0, sum(1 for p in query.split("&") if p),
            len(query), len(labels), max(map(len, labels)), host.count("-"), float(bool(hash_)))


def _with_lexical(df: DataFrame, url: str) -> DataFrame:
    from eventlake.llm.shared import append_columns

    def compute(urls: pa.Array) -> list[pa.Array]:
        rows = np.array([_lexical(u or "") for u in urls.to_pylist()], float).reshape(-1, len(LEXICAL))
        return [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(LEXICAL))]

    return append_columns(df, url, compute, ", ".join(f"{c} double" for c in LEXICAL))


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def suffix_statistics(labelled: DataFrame, labels: int) -> DataFrame:
    """(suffix, n, blocked, folds): counts over all labelled URLs (``n`` copies
    of a row, if it has that column), in total and by fold of the host."""
    n = F.col("n") if "n" in labelled.columns else F.lit(1)
    by_fold = (labelled.groupBy(_suffix(F.col("host"), labels).alias("suffix"), "fold")
               .agg(F.sum(n).alias("n"), F.sum(F.col("label") * n).alias("blocked")))
    return by_fold.groupBy("suffix").agg(
        F.sum("n").alias("n"), F.sum("blocked").alias("blocked"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "blocked")))).alias("folds"))


def _with_suffix(df: DataFrame, stats: DataFrame, labels: int, base: float) -> DataFrame:
    """Smoothed share of blocked URLs and log count of the host's suffix; for
    rows with a label, without the fold of their host."""
    df = df.withColumn("suffix", _suffix(F.col("host"), labels))
    joined = join_group_stats(df, stats, ["suffix"], how="left", max_rows=MAX_SUFFIXES_TO_BROADCAST)
    own = F.when(F.col("label").isNotNull(), F.col("folds")[F.col("fold")])
    n = F.coalesce(F.col("n"), F.lit(0)) - F.coalesce(own["n"], F.lit(0))
    blocked = F.coalesce(F.col("blocked"), F.lit(0)) - F.coalesce(own["blocked"], F.lit(0))
    share = (blocked + SMOOTHING * base) / (n + SMOOTHING)
    return (joined.withColumn(f"suffix{labels}_share", share).withColumn(f"suffix{labels}_log_n", F.log1p(n))
            .drop("suffix", "n", "blocked", "folds"))


def judge(urls: DataFrame, rules: dict[str, str], url: str = "url", key: str = "page_id",
          labelled: DataFrame | None = None, max_train: int = MAX_TRAIN) -> DataFrame:
    """(key, host, path, rule, verdict, score) of every row; ``score`` is the
    trees' probability of block, null where a rule decides. ``labelled`` has
    (url, label) rows, label 1 for block; by default the rows with a rule."""
    host, path = url_parts(F.col("url"))

    def prepared(df: DataFrame) -> DataFrame:
        return df.withColumn("host", host).withColumn("path", path)

    rows = prepared(urls.select(quoted(key).alias("key"), quoted(url).alias("url")))
    verdicts = F.create_map(*[x for r, v in rules.items() for x in (F.lit(r), F.lit(v))]) if rules else None
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("ruled", verdicts[F.col("rule")] if rules else F.lit(None).cast("string"))
    if labelled is None:
        known = rows.where(F.col("rule").isNotNull()).withColumn("label", (F.col("ruled") == "block").cast("int"))
    else:
        known = prepared(labelled.select(F.col("url"), F.col("label").cast("int").alias("label")))
        known = known.where(F.col("label").isNotNull())
    fold = F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")
    known = (known.groupBy("url", "host", "path", "label", fold.alias("fold"))
             .agg(F.count(F.lit(1)).alias("n")))  # copies of a url are one row of their weight
    known, seen = stage_counted(known, "url_labels", blocked=F.sum(F.col("label") * F.col("n")), labelled=F.sum("n"))
    out = ["key", "host", "path", "rule"]
    if not 0 < seen["blocked"] < seen["labelled"]:
        done = rows.select(*out, F.coalesce("ruled", F.lit("allow")).alias("verdict"),
                           F.lit(None).cast("double").alias("score"))
        return done.withColumnRenamed("key", key)

    base = seen["blocked"] / seen["labelled"]
    stats = {n: stage(suffix_statistics(known, n), f"url_suffix{n}") for n in (1, 2)}

    def featured(df: DataFrame) -> DataFrame:
        df = _with_lexical(df, "url")
        for n in (1, 2):
            df = _with_suffix(df, stats[n], n, base)
        return VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features").transform(df)

    chosen = known
    if seen["rows"] > max_train:
        share = max_train / seen["rows"]
        chosen = known.where(F.pmod(F.xxhash64("url"), F.lit(1_000_003)) < int(share * 1_000_003))
    # at most about max_train different urls, in an order of their own, so that reruns fit the same trees
    chosen = stage(chosen.repartition(1).sortWithinPartitions("url", "label"), "url_training")
    train = featured(chosen.withColumnRenamed("n", "copies")).select(
        "features", F.col("label").cast("double").alias("label"), F.col("copies").cast("double").alias("weight"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, weightCol="weight").fit(train)
    # a row that trained must be judged like any other: no label, no fold
    todo = rows.withColumn("label", F.lit(None).cast("int")).withColumn("fold", F.lit(None).cast("int"))
    scored = trees.transform(featured(todo.where(F.col("rule").isNull())))
    scored = scored.select(*out, "ruled", vector_to_array("probability")[1].alias("score"))
    ruled = rows.where(F.col("rule").isNotNull()).select(*out, "ruled", F.lit(None).cast("double").alias("score"))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return ruled.unionByName(scored).select(*out, verdict.alias("verdict"), "score").withColumnRenamed("key", key)
