"""Toxicity classifier with counterfactual regularisation.

A logistic model over words and word beginnings, each present at all or at
least twice. The vocabulary is chosen from the training documents' counts by
class; identity terms always belong to it and give no other feature.
For every labelled text with an identity term, the term is swapped for the
others of its group, and the training loss penalises the squared difference of
the scores (log-odds) of the text and its swap. A group's name by itself then
moves the score as little as any other's, so neutral mentions are not taken
for toxic because the name is frequent in toxic training texts.

Scale: training uses at most ``MAX_TRAIN`` labelled documents (chosen by a hash
of their id, so reruns agree) and ``VOCABULARY`` words; both are documented
bounds of the model, and the matrix of the fit follows from them. Scoring reads
every whole text once, without a shuffle.

Defined cases: null and empty texts score the intercept; labels without a value
or a document are ignored, repeated labels count once (toxic if any says so);
without both classes among the training rows every score is the share of toxic
ones (0 without rows); rows are scored independently.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import append_columns, free_prefix, quoted, stage, stage_counted

MAX_TRAIN = 20_000
VOCABULARY = 512
MIN_DOCS = 5
BEGINNINGS = (4, 5, 6)  # characters
AGAIN = "#2"  # suffix of a feature that occurs at least twice
FOLDS = 5

# Identity terms by group (fixed values); within a group any term may replace another.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young"),
)

# ASCII letters stay, other ASCII becomes a space, everything beyond ASCII stays.
LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def tokens(text: str | None) -> Counter:
    """Counts of the lower-cased words of a text."""
    raw = (text or "").lower().encode("utf-8", "replace").translate(LETTERS)
    counts = Counter(raw.decode("utf-8", "replace").split(" "))
    counts.pop("", None)
    return counts


def features(counts: Counter, identity: frozenset) -> set[str]:
    """All features of a text: words, ``^`` beginnings, and either with ``AGAIN``."""
    found: Counter = Counter()
    out = set()
    for w, n in counts.items():
        if w in identity:
            out.add(w)
            continue
        found[w] += n
        for k in BEGINNINGS:
            if len(w) > k:
                found["^" + w[:k]] += n
    out.update(found)
    out.update(f + AGAIN for f, n in found.items() if n > 1)
    return out


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows never learnt from: crc32 of the id's text divisible by ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    identity: frozenset = frozenset()

    def __post_init__(self):
        """What a word must be or begin with to matter."""
        names = {f.removesuffix(AGAIN) for f in self.weights}
        self.words = {f for f in names if f[0] != "^"}
        self.starts = {f[1:1 + BEGINNINGS[0]] for f in names if f[0] == "^"}

    def score(self, text: str | None) -> float:
        k = BEGINNINGS[0]
        matter = Counter({w: n for w, n in tokens(text).items() if w in self.words or w[:k] in self.starts})
        known = features(matter, self.identity) & self.weights.keys()
        z = self.bias + sum(self.weights[f] for f in sorted(known))
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def swaps(words: set[str], groups=IDENTITY) -> list[tuple[str, str]]:
    """(term, replacement) for every identity term of a text."""
    return [(a, b) for g in groups for a in g if a in words for b in g if b != a]


def fit_weights(texts: list[set[str]], toxic: list[int], vocabulary: list[str], groups=IDENTITY,
                l2: float = 0.3, fairness: float = 10.0, rounds: int = 25) -> Model:
    """Newton's method on the penalised logistic loss; ``texts`` hold the features of each text."""
    y = np.array(toxic, float)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return Model(40.0 if share == 1 else -40.0)
    words = list(dict.fromkeys([*vocabulary, *(t for g in groups for t in g)]))
    col = {w: i + 1 for i, w in enumerate(words)}
    x = np.zeros((len(texts), len(words) + 1), np.float32)
    x[:, 0] = 1
    change = np.zeros((len(words) + 1, len(words) + 1))  # sum of outer products of (text - swapped text)
    for i, known in enumerate(texts):
        for w in known:
            if w in col:
                x[i, col[w]] = 1
        for a, b in swaps(known, groups):
            j, k = col[a], col[b]
            if b in known:  # the swapped text loses a and keeps b
                change[j, j] += 1
            else:
                change[j, j] += 1
                change[k, k] += 1
                change[j, k] -= 1
                change[k, j] -= 1
    ridge = np.full(x.shape[1], l2)
    ridge[0] = 1e-6
    penalty = np.diag(ridge) + 2 * fairness * change
    beta = np.zeros(x.shape[1])
    beta[0] = math.log(share / (1 - share))
    for _ in range(rounds):
        z = np.clip(x @ beta, -30, 30)
        p = 1 / (1 + np.exp(-z))
        grad = x.T @ (p - y) + penalty @ beta
        w = np.maximum(p * (1 - p), 1e-6).astype(np.float32)
        bend = penalty.copy()
        for i in range(0, len(x), 1000):  # a copy of few rows at a time
            bend += (x[i:i + 1000] * w[i:i + 1000, None]).T @ x[i:i + 1000]
        step = np.linalg.solve(bend, grad)
        beta -= step * min(1.0, 5.0 / max(float(np.abs(step).max()), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return Model(float(beta[0]), {w: float(beta[j]) for w, j in col.items() if beta[j]},
                 frozenset(t for g in groups for t in g))


def training_rows(labels: DataFrame, doc_id: str = "doc_id", toxic: str = "toxic",
                  max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, toxic) of at most about ``max_train`` labelled documents outside the held-out fold."""
    rows = (labels.select(quoted(doc_id).alias("doc_id"), quoted(toxic).cast("int").alias("toxic"))
            .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .where(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    rows, seen = stage_counted(rows, "toxic_labels")
    if seen["rows"] > max_train:
        share = max_train / seen["rows"]
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003))
    return rows


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic",
        max_train: int = MAX_TRAIN, vocabulary: int = VOCABULARY, groups=IDENTITY, **kw) -> Model:
    """Model from the labelled documents outside the held-out fold. Of several
    texts under one id the one with the smallest digest trains."""
    chosen = F.broadcast(training_rows(labels, doc_id, toxic, max_train))  # max_train rows at most
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")).join(chosen, "doc_id")
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))  # of several texts under one id always the same
    rows = rows.groupBy("doc_id", "toxic").agg(F.min_by(F.struct("text"), digest).alias("one"))
    rows = rows.select("doc_id", "toxic", "one.text")

    identity = frozenset(t for g in groups for t in g)

    def words_of(texts):
        import pyarrow as pa

        return [pa.array([sorted(features(tokens(t), identity)) for t in texts.to_pylist()], pa.list_(pa.string()))]

    rows = stage(append_columns(rows, "text", words_of, "words array<string>").select("doc_id", "toxic", "words"),
                 "toxic_words")
    sums = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    n, n_toxic = sums[0], sums[1] or 0
    if not 0 < n_toxic < n:
        return fit_weights([], [], [], groups) if not n else fit_weights([set()], [int(n_toxic > 0)], [], groups)
    counts = (rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).where(F.col("n") >= MIN_DOCS))
    expected = F.col("n") * F.lit(n_toxic / n)
    chi = F.pow(F.col("t") - expected, 2) / (expected * F.lit(1 - n_toxic / n))
    best = [r.word for r in counts.orderBy(chi.desc(), "word").limit(vocabulary).select("word").collect()]
    every = F.array(*[F.lit(w) for w in [*best, *(t for g in groups for t in g)]])
    known = rows.select("toxic", F.array_intersect("words", every).alias("known")).orderBy("doc_id").collect()
    return fit_weights([set(r.known) for r in known], [r.toxic for r in known], best, groups, **kw)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "toxicity") -> DataFrame:
    """``docs`` with the score of every whole text in ``column``."""

    def compute(texts):
        import pyarrow as pa

        return [pa.array([model.score(t) for t in texts.to_pylist()], pa.float64())]

    return append_columns(docs, text, compute, f"`{column}` double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **kw) -> DataFrame:
    """The documents that score under ``threshold``, their columns unchanged whatever their names."""
    column = free_prefix(docs.columns, "toxicity_") + "score"
    scored = score(docs, fit(docs, labels, **kw), column=column)
    return scored.where(F.col(column) < threshold).drop(column)
