"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Every source gets a word budget: its share of all words by weight, at most
``cap`` times its own size, the excess shared again by weight. A source gives
as many complete epochs as fit; the rest is a weighted sample without
replacement: each document draws the key -ln(u)/w with u from a hash of its id
(so reruns agree) and w its quality weight, and documents are taken in key
order until the budget is met.

Scale: no row is sorted globally and no source lands in one task. Keys are cut
into ``BINS`` bins per source; sizes are summed per bin (partial aggregates),
the one bin in which the budget ends is found from those sums, and only its
rows are sorted, which gives the source's cut key. The selection itself is then
a filter with one small row per source, so texts are never shuffled.

Defined cases: a null text has size 0; null sources form one source, weighed
last; documents without words take 0 and follow their source's cut; rows equal
in id share a key and are taken or left together; an empty table gives no rows;
other columns may have any names (``take_mix`` names its own apart from them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import ASCII_WORD, free_prefix, quoted, stage
from eventlake.operators.joins import bounded_side

BINS = 4096
MAX_SOURCES_TO_BROADCAST = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(ASCII_WORD)), F.lit(0)).cast("long")


def prose_weight(text: Column, size: Column) -> Column:
    """Quality weight of a document: 1, a quarter of it where the mean word is
    not 3 to 12 characters long with its space, half of it under 50 words."""
    mean = F.coalesce(F.char_length(text), F.lit(0)) / F.greatest(size, F.lit(1))
    return (F.when(mean.between(3, 12), F.lit(1.0)).otherwise(F.lit(0.25))
            * F.when(size >= 50, F.lit(1.0)).otherwise(F.lit(0.5)))


def sampling_key(doc_id: Column, weight: Column) -> Column:
    """Exponential key -ln(u)/w; u in (0, 1) from 52 bits of the id's md5."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16 ** 13))
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights=(1.0, 2.0, 3.0), cap: float = 3.0, share: float = 1.0) -> DataFrame:
    """(source, source_size) -> + weight, target.

    Sources by code point, null last, take ``weights`` in turn. With the
    sources sorted by cap per weight, the budget level is the water level at
    which the sources below their cap share what the capped ones leave. One
    row per source, so the two windows over all rows are small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int"))
    t = sizes.withColumn("weight", w).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    by_fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(every) * F.lit(float(share)) - (F.sum("limit").over(upto) - F.col("limit"))
    open_weight = F.sum("weight").over(every) - (F.sum("weight").over(upto) - F.col("weight"))
    t = t.withColumn("level", left / open_weight)
    level = F.max(F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level"))).over(every)
    t = t.withColumn("level", level)
    target = F.least(F.col("limit"), F.coalesce(F.col("weight") * F.col("level"), F.col("limit")))
    return t.select("source", "source_size", "weight", F.greatest(target, F.lit(0.0)).alias("target"))


def source_plan(rows: DataFrame, **targets) -> DataFrame:
    """(source, size, draw) rows -> one row per source: source_size, target,
    epochs, and the cut key up to which documents are taken once more."""
    bin_of = F.least(F.floor(F.col("draw") / (F.col("draw") + 1.0) * BINS), F.lit(BINS - 1)).cast("int")
    rows = rows.withColumn("bin", bin_of)
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"), F.max("draw").alias("bin_cut"))
    bins = stage(bins, "mix_bins")
    plan = source_targets(bins.groupBy("source").agg(F.sum("bin_size").alias("source_size")), **targets)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs.cast("int"))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = stage(plan, "mix_plan")
    small, fits = bounded_side(plan, MAX_SOURCES_TO_BROADCAST, "mix_sources")
    small = F.broadcast(small) if fits else small

    def of_source(df: DataFrame, info: DataFrame, *cols: str) -> DataFrame:
        return (df.alias("l").join(info.select(F.col("source").alias("s2"), *cols).alias("r"),
                                   F.col("l.source").eqNullSafe(F.col("r.s2"))).drop("s2"))

    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = of_source(bins, small, "rest").withColumn("upto", F.sum("bin_size").over(before))
    ends = filled.groupBy("source").agg(
        F.max(F.when(F.col("upto") <= F.col("rest"), F.col("bin_cut"))).alias("whole_cut"),
        F.min(F.when(F.col("upto") > F.col("rest"), F.col("bin"))).alias("last_bin"),
        F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("base"))
    ends = stage(of_source(ends, small, "source_size", "target", "epochs", "rest"), "mix_ends")
    few, fits = bounded_side(ends, MAX_SOURCES_TO_BROADCAST, "mix_ends")
    few = F.broadcast(few) if fits else few

    # rows of the bin in which each budget ends, equal keys together
    tail = of_source(rows, few, "last_bin", "base", "rest").where(F.col("bin") == F.col("last_bin"))
    tail = tail.groupBy("source", "draw").agg(F.sum("size").alias("size"), F.first("base").alias("base"),
                                              F.first("rest").alias("rest"))
    by_key = Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.coalesce(F.col("base"), F.lit(0)) + F.sum("size").over(by_key) - F.col("size") / 2
    tail = (tail.withColumn("ok", middle <= F.col("rest")).where("ok")
            .groupBy("source").agg(F.max("draw").alias("tail_cut")).withColumnRenamed("source", "s3"))
    return (ends.join(tail, F.col("source").eqNullSafe(F.col("s3")), "left")
            .select("source", "source_size", "target", "epochs",
                    F.when(F.col("rest") > 0, F.greatest("whole_cut", "tail_cut")).alias("cut")))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weight: Column | None = None, prefix: str = "mix_", **targets) -> DataFrame:
    """``docs`` with columns ``<prefix>size``, ``source_size``, ``target`` and
    ``copies`` (how often the mix takes the document, 0 to the cap). ``weight``
    is the documents' quality weight (positive), by default ``prose_weight``."""
    size = word_count(quoted(text))
    names = {n: prefix + n for n in ("size", "draw", "source_size", "target", "copies")}
    clash = set(names.values()) & set(docs.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}; choose another prefix")
    sized = docs.withColumn(names["size"], size)
    w = prose_weight(quoted(text), quoted(names["size"])) if weight is None else weight
    sized = sized.withColumn(names["draw"], sampling_key(quoted(doc_id), w))
    narrow = sized.select(quoted(source).alias("source"), quoted(names["size"]).alias("size"),
                          quoted(names["draw"]).alias("draw"))
    plan, fits = bounded_side(source_plan(stage(narrow, "mix_rows"), **targets), MAX_SOURCES_TO_BROADCAST, "mix_cuts")
    of = free_prefix([*docs.columns, *names.values()], "plan_")
    plan = plan.select(*[F.col(c).alias(of + c) for c in plan.columns])
    out = sized.join(F.broadcast(plan) if fits else plan, quoted(source).eqNullSafe(quoted(of + "source")))
    again = F.coalesce((quoted(names["draw"]) <= quoted(of + "cut")), F.lit(False)).cast("int")
    return (out.withColumn(names["copies"], quoted(of + "epochs") + again)
            .withColumn(names["source_size"], quoted(of + "source_size"))
            .withColumn(names["target"], quoted(of + "target"))
            .drop(names["draw"], *plan.columns))


def take_mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, columns unchanged."""
    prefix = kw.pop("prefix", None) or free_prefix(docs.columns, "mix_")
    mixed = mix(docs, prefix=prefix, **kw)
    copies = F.explode(F.array_repeat(F.lit(1), quoted(prefix + "copies")))
    return mixed.withColumn(free_prefix(mixed.columns, "copy_"), copies).select(*[quoted(c) for c in docs.columns])
