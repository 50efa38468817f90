"""Daily percentile query: distinct-event threshold and percentile summaries
per group (default: device type x day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.numeric import round_half_up
from eventlake.operators.joins import (BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, join_group_stats,
                                       materialize_measured, null_safe_join)
from eventlake.operators.outliers import remove_outliers
from eventlake.operators.quality import prepare
from eventlake.schema import DEFAULT_GROUP, MIN_EVENTS, OUTLIER_METHOD, OUTLIER_SIGMA, PERCENTILE_PROBS

EVENT_KEY = ("device_id", "timestamp")


def _distinct_events_expr(approx: bool) -> Column:
    if approx:
        # HLL sketch; rows with a null key part are skipped like the exact form
        return F.approx_count_distinct(
            F.when(F.col("device_id").isNotNull() & F.col("timestamp").isNotNull(), F.struct(*EVENT_KEY))
        )
    return F.count_distinct(*[F.col(c) for c in EVENT_KEY])


def distinct_events(df: DataFrame, by: Sequence[str] = DEFAULT_GROUP, approx: bool = False) -> DataFrame:
    """Distinct (device_id, timestamp) per group; a row with a null key part
    is not counted. The exact form is planned as two aggregations (by group +
    event key, then by group), both partial, so duplicates collapse map-side."""
    return df.groupBy(*by).agg(_distinct_events_expr(approx).alias("distinct_events"))


def keep_groups(df: DataFrame, by: Sequence[str] = DEFAULT_GROUP, min_events: int = MIN_EVENTS,
                approx: bool = False) -> DataFrame:
    """Rows of groups with at least ``min_events`` distinct events.

    The kept keys are unique and key-only, so the join is a left-semi join;
    broadcast behind a measured bound (``join_group_stats``)."""
    kept = distinct_events(df, by, approx).filter(F.col("distinct_events") >= min_events).select(*by)
    return join_group_stats(df, kept, by, how="left_semi")


def percentile_name(p: float) -> str:
    """``0.95`` -> ``percentile_95th``."""
    return f"percentile_{int(round(p * 100))}th"


KLL_K = 8192  # KLL sketch size: exact for groups of at most this many values
SALT_BUCKETS = 64  # reducers sharing the sketch merge of one group
SELECT_ROWS = 1_000_000  # counted values of a group that are put in order to select the exact quantiles


def distinct_counts(df: DataFrame, by: Sequence[str] = DEFAULT_GROUP, approx: bool = False) -> DataFrame:
    """Per group: distinct devices and distinct (device_id, timestamp) events.

    The events are grouped once by (group, device, time) and rolled up to
    (group, device) and to the group, where both distinct counts are counts of
    rows: every level combines before its shuffle, and no row is expanded."""
    if approx:
        return df.groupBy(*by).agg(F.count_distinct(F.col("device_id")).alias("unique_devices"),
                                   _distinct_events_expr(True).alias("distinct_events"))
    each = df.select(*by, *EVENT_KEY).distinct()
    devices = each.groupBy(*by, "device_id").agg(F.count("timestamp").alias("_events"))
    return devices.groupBy(*by).agg(
        F.count("device_id").alias("unique_devices"),
        F.coalesce(F.sum(F.when(F.col("device_id").isNotNull(), F.col("_events"))), F.lit(0)).alias("distinct_events"))


def rank_error(k: int) -> float:
    """Generous bound of a KLL sketch's normalised rank error."""
    return 8.0 / k ** 0.9


def quantile_summary(df: DataFrame, by: Sequence[str], col: str, probs: Sequence[float], k: int = KLL_K,
                     buckets: int = SALT_BUCKETS) -> DataFrame:
    """Per group: KLL sketch (``_sk``), rows (``_n``), mean (``_mean``) and sum
    of squared deviations (``_m2``) of the values of ``col``.

    Two levels: level 1 groups by (group, salt) with salt = input task id mod
    ``buckets``, so a task still ships one sketch per group, but the merge of a
    group holding a third of the data is spread over ``buckets`` reducers;
    level 2 merges those. Null and NaN values are left out; a group of nothing
    else has 0 rows and null moments."""
    x = F.col(col).cast("double")
    salted = df.select(*by, F.when(~F.isnan(x), x).alias("_x"), F.pmod(F.spark_partition_id(), F.lit(buckets)).alias("_salt"))
    level1 = salted.groupBy(*by, "_salt").agg(
        F.kll_sketch_agg_double("_x", F.lit(k)).alias("_sk"), F.count("_x").alias("n"),
        F.coalesce(F.avg("_x"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop("_x") * F.count("_x"), F.lit(0.0)).alias("m2"))
    level2 = level1.groupBy(*by).agg(F.kll_merge_agg_double("_sk").alias("_sk"), F.sum("n").alias("_n"),
                                     F.collect_list(F.struct("n", "mean", "m2")).alias("_parts"))
    zero = F.lit(0.0)
    mean = F.try_divide(F.aggregate("_parts", zero, lambda a, p: a + p["mean"] * p["n"]), F.col("_n"))
    level2 = level2.withColumn("_mean", mean)
    m2 = F.aggregate("_parts", zero, lambda a, p: a + p["m2"] + p["n"] * F.pow(p["mean"] - F.col("_mean"), 2))
    return level2.withColumn("_m2", m2).drop("_parts")


def _sketch_quantiles(sketch: str, ranks: Column | Sequence[float]) -> list[Column]:
    """The sketch's quantiles; null where the group has no values (``_n`` is 0)."""
    return [F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double(sketch, r)) for r in ranks]


BINS = 4096  # of a counted histogram


def exact_quantiles(df: DataFrame, summary: DataFrame, by: Sequence[str], col: str, probs: Sequence[float],
                    k: int = KLL_K, select_rows: int = SELECT_ROWS) -> DataFrame:
    """``summary`` (``quantile_summary``) with ``_q``: the exact discrete
    quantiles (the smallest value whose cumulative share reaches p), at any
    group size and equal on every run.

    A sketch of at most ``k`` values is exact. For larger groups its rank error
    gives an interval around each wanted quantile, and one pass over the rows
    counts them for all groups and ranks at once: every value inside an
    interval by itself, the rows of each gap between intervals as one number.
    The running count over these numbers selects the quantiles; a rank that
    falls into a gap (the sketch was worse than its bound) makes that gap an
    interval of another pass. Where a group has more than ``select_rows``
    counted values, counted histograms over them (``_narrowed``) leave only
    those near the wanted ranks. No group is ever in one task.

    The passes are jobs: this function runs them, and returns a plan over
    written tables."""
    quantiles = F.array(*_sketch_quantiles("_sk", [F.lit(float(p)) for p in probs]))
    key_bytes = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in by])))) if by else F.lit(0)
    table, seen = materialize_measured(summary.withColumn("_q", quantiles), "quantile_summary", most=F.max("_n"),
                                       bytes=key_bytes)
    if seen["most"] <= k:
        return table.drop("_sk")
    # what is joined below has one row per group: the keys and a few numbers per rank
    few = (seen["rows"] <= BROADCAST_MAX_ROWS
           and seen["bytes"] + seen["rows"] * 64 * (len(probs) + 1) <= BROADCAST_MAX_BYTES)
    large = table.filter(F.col("_n") > k)
    x = F.col(col).cast("double")
    rows = df.select(*by, x.alias("_x")).filter(~F.isnan("_x"))
    wanted = F.array(*[F.greatest(F.ceil(F.col("_n") * p - 1e-9), F.lit(1)).cast("bigint") for p in probs])
    error = rank_error(k)

    def interval(p: float) -> Column:
        lo, hi = _sketch_quantiles("_sk", [F.lit(min(max(r, 0.0), 1.0)) for r in (p - error, p + error)])
        return F.struct(lo.alias("lo"), hi.alias("hi"))

    state = large.select(*by, wanted.alias("_r"), F.array(*[interval(float(p)) for p in probs]).alias("_b"))
    while True:
        counted, seen = materialize_measured(_counted(rows, state, by, few), "quantile_counts")
        wants = state.select(*by, "_r")
        if seen["rows"] > select_rows:
            counted = _narrowed(counted, wants, by, select_rows)
        upto = Window.partitionBy(*by).orderBy("_cell", F.col("_x").asc_nulls_first())
        upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = counted.withColumn("_upto", F.sum("_c").over(upto))
        numbered = F.transform("_r", lambda r, i: F.struct(i.alias("_i"), r.alias("_r")))
        hits = F.filter(numbered, lambda w: (w["_r"] <= F.col("_upto")) & (w["_r"] > F.col("_upto") - F.col("_c")))
        found = null_safe_join(running, wants, by, broadcast=few).select(*by, "_cell", "_x", F.explode(hits).alias("_h"))
        found = found.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_h._i", "_x", "_cell"))).alias("_found"))
        found, seen = materialize_measured(found, "quantile_found", misses=F.sum(
            F.exists("_found", lambda f: f["_x"].isNull()).cast("int")))
        if not seen["misses"]:
            break
        # the gaps that hold a wanted rank become intervals themselves
        ends = F.array_sort(F.array_distinct(F.flatten(F.transform("_b", lambda b: F.array(b["lo"], b["hi"])))))
        open_ = null_safe_join(state.withColumn("_e", ends), found, by)
        infinity = F.lit(float("inf"))
        gap = F.transform("_found", lambda f: F.when(f["_x"].isNotNull(), F.struct(
            f["_x"].alias("lo"), f["_x"].alias("hi"))).otherwise(F.struct(
                F.coalesce(F.get(F.col("_e"), f["_cell"] - 1), -infinity).alias("lo"),
                F.coalesce(F.get(F.col("_e"), f["_cell"]), infinity).alias("hi"))))
        state, _ = materialize_measured(open_.select(*by, "_r", gap.alias("_b")), "quantile_state")
    exact = found.select(*by, F.transform("_found", lambda f: f["_x"]).alias("_exact"))
    joined = null_safe_join(table, exact, by, "left", broadcast=few)
    return joined.withColumn("_q", F.coalesce("_exact", "_q")).drop("_exact", "_sk")


def _counted(rows: DataFrame, state: DataFrame, by: Sequence[str], few: bool) -> DataFrame:
    """(by, _cell, _x, _c): rows per value inside an interval, and per gap
    between the intervals (``_x`` null). The cell is the number of interval
    ends below the value, so (_cell, _x with nulls first) is the order of values."""
    joined = null_safe_join(rows, state.select(*by, "_b"), by, broadcast=few)
    ends = F.array_distinct(F.flatten(F.transform("_b", lambda b: F.array(b["lo"], b["hi"]))))
    cell = F.size(F.filter(ends, lambda v: v < F.col("_x")))
    inside = F.exists("_b", lambda b: F.col("_x").between(b["lo"], b["hi"]))
    keyed = joined.select(*by, cell.alias("_cell"), F.when(inside, F.col("_x")).alias("_x"))
    return keyed.groupBy(*by, "_cell", "_x").agg(F.count(F.lit(1)).alias("_c"))


def _log_place(x: Column) -> Column:
    """A number that grows with ``x`` and with the logarithm of its size (``log`` never falls)."""
    return F.when(x > 0, F.log(x) + 800).when(x < 0, -(F.log(-x) + 800)).otherwise(F.lit(0.0))


def _narrowed(counted: DataFrame, wants: DataFrame, by: Sequence[str], select_rows: int) -> DataFrame:
    """``counted`` with the values away from the wanted ranks added up.

    Each round cuts the runs of single values (at first, one per cell) into
    ``BINS`` ranges between their least and greatest value and counts them: of
    equal width, or of equal ratio where the values differ by more than a factor
    of 2, so a few rounds are enough for any doubles. A bin without a wanted rank becomes one entry (its least value and its
    rows), the others are the runs of the next round, until no run has more
    than ``select_rows`` values. A run's ends fall into different bins, so every
    round makes progress, and it reads only what the last one left."""
    run = [*by, "_cell", "_run"]
    single = counted.filter(F.col("_x").isNotNull()).withColumn("_run", F.lit(0.0))
    done = counted.filter(F.col("_x").isNull()).select(*by, "_cell", "_x", "_c")
    finite = F.when(F.abs("_x") < F.lit(float("inf")), F.col("_x"))
    while True:
        spans, seen = materialize_measured(
            single.groupBy(*run).agg(F.count(F.lit(1)).alias("_k"), F.min(finite).alias("_first"),
                                     F.max(finite).alias("_last")), "quantile_spans", most=F.max("_k"))
        if seen["most"] <= select_rows:
            return done.unionByName(single.select(*by, "_cell", "_x", "_c"))
        first, last = F.col("_first"), F.col("_last")
        near = ((first > 0) & (last / 2 <= first)) | ((last < 0) & (first / 2 >= last)) | (first == last)
        part = F.when(near, F.try_divide(F.col("_x") - first, last - first)).otherwise(
            F.try_divide(_log_place(F.col("_x")) - _log_place(first), _log_place(last) - _log_place(first)))
        inner = F.least(F.greatest(F.floor(F.coalesce(part, F.lit(0.0)) * BINS), F.lit(0)), F.lit(BINS - 1))
        place = (F.when(F.col("_x") == float("inf"), F.lit(BINS)).when(F.col("_x") == float("-inf"), F.lit(-1))
                 .otherwise(inner).cast("int"))
        binned = join_group_stats(single, spans.select(*run, "_first", "_last"), run).withColumn("_bin", place)
        bins = binned.groupBy(*run, "_bin").agg(F.min("_x").alias("_x"), F.sum("_c").alias("_c"))
        each = done.withColumns({"_run": F.lit(None).cast("double"), "_bin": F.lit(None).cast("int")})
        upto = Window.partitionBy(*by).orderBy("_cell", F.col("_x").asc_nulls_first())
        running = each.unionByName(bins).withColumn(
            "_upto", F.sum("_c").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        hit = F.exists("_r", lambda w: (w <= F.col("_upto")) & (w > F.col("_upto") - F.col("_c")))
        judged, _ = materialize_measured(null_safe_join(running, wants, by).withColumn("_hit", hit & F.col("_bin").isNotNull())
                                         .select(*run, "_bin", "_x", "_c", "_hit"), "quantile_bins")
        done = judged.filter(~F.col("_hit")).select(*by, "_cell", "_x", "_c")
        wide = judged.filter("_hit").select(*run, "_bin", F.col("_x").alias("_next"))
        single = join_group_stats(binned.select(*run, "_bin", "_x", "_c"), wide, [*run, "_bin"])
        single, _ = materialize_measured(single.select(*by, "_cell", F.col("_next").alias("_run"), "_x", "_c"),
                                         "quantile_singles")


METHODS = ("exact", "kll", "approx")


def percentiles(df: DataFrame, by: Sequence[str] = DEFAULT_GROUP, probs: Sequence[float] = PERCENTILE_PROBS,
                accuracy: int = 10000, col: str = "event_duration", digits: int | None = 3,
                with_distinct_events: bool = False, approx_distinct: bool = False, method: str = "exact",
                k: int = KLL_K, buckets: int = SALT_BUCKETS, select_rows: int = SELECT_ROWS) -> DataFrame:
    """Per group: percentiles of ``col``, mean, sample stddev, count and
    distinct devices (with ``with_distinct_events`` also the distinct
    (device_id, timestamp) count).

    ``method``: ``exact`` (default) gives the exact discrete quantiles at any
    group size (``exact_quantiles``; it runs its passes as jobs while the plan
    is built); ``kll`` takes the sketches' answer, exact up to ``k`` values a
    group and within ``rank_error(k)`` above, where it differs from run to run;
    ``approx`` is ``percentile_approx`` with ``accuracy``, one merge per group.
    Quantiles and moments come out of one aggregate, the distinct counts out of
    a second one (``distinct_counts``); they are joined on the group key.

    Rows with null key parts form groups like any other. Null and NaN values are
    left out of quantiles, moments and ``total_events``; a group that has only
    such values stays, with 0 and nulls. Infinite values take part in the
    quantiles and make the mean infinite and the deviation NaN.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    probs = list(probs)
    if method == "approx":
        x = F.col(col)
        q = df.groupBy(*by).agg(F.percentile_approx(x, probs, accuracy).alias("_q"), F.count(x).alias("_n"),
                                F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_sd"))
    else:
        q = quantile_summary(df, by, col, probs, k, buckets)
        if method == "exact":
            q = exact_quantiles(df, q, by, col, probs, k, select_rows)
        else:
            q = q.withColumn("_q", F.array(*_sketch_quantiles("_sk", [F.lit(float(p)) for p in probs]))).drop("_sk")
        q = q.withColumn("_sd", F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1))))
    agg = null_safe_join(q, distinct_counts(df, by, approx_distinct), by)

    def rnd(c: Column) -> Column:
        return c if digits is None else round_half_up(c, digits)

    return agg.select(
        *by,
        *[rnd(F.col("_q")[i]).alias(percentile_name(p)) for i, p in enumerate(probs)],
        rnd(F.col("_mean")).alias("mean_event_duration"),
        rnd(F.col("_sd")).alias("stddev_event_duration"),
        F.col("_n").alias("total_events"),
        "unique_devices",
        *(["distinct_events"] if with_distinct_events else []),
    )


def with_run_metadata(df: DataFrame, min_events: int, as_of: str | None = None,
                      method: str = OUTLIER_METHOD) -> DataFrame:
    """Run metadata columns: computation time (``as_of`` or now), outlier
    method and threshold."""
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return (
        df.withColumn("computation_timestamp", ts)
        .withColumn("outlier_method", F.lit(method))
        .withColumn("min_events_threshold", F.lit(int(min_events)))
    )


def percentile_report(events: DataFrame, by: Sequence[str] = DEFAULT_GROUP, min_events: int = MIN_EVENTS,
                      sigma: float = OUTLIER_SIGMA, probs: Sequence[float] = PERCENTILE_PROBS,
                      approx_distinct: bool = False, count_before_outliers: bool = False,
                      as_of: str | None = None, digits: int | None = 3, sort: bool = True,
                      method: str = "exact", k: int = KLL_K) -> DataFrame:
    """The batch query: clean -> drop 3-sigma outliers -> keep groups with at
    least ``min_events`` distinct events -> percentile summary per group.

    Plan: pass 1 is a partial aggregate of the group statistics,
    materialised and broadcast back to the rows (size checked). Over the
    outlier-free rows, the percentile summary and the distinct counts are two
    aggregates joined on the group key (see ``percentiles``); keeping a group
    is then a filter on its summary row (HAVING), not a join of the events
    with the kept groups. With ``count_before_outliers`` the distinct events
    are counted on the cleaned rows instead.
    """
    cleaned = prepare(events)
    clean = remove_outliers(cleaned, by, sigma)
    if count_before_outliers:
        counts = distinct_events(cleaned, by, approx_distinct)
        summary = null_safe_join(percentiles(clean, by, probs, digits=digits, approx_distinct=approx_distinct,
                                             method=method, k=k), counts, by)
    else:
        summary = percentiles(clean, by, probs, digits=digits, with_distinct_events=True,
                              approx_distinct=approx_distinct, method=method, k=k)
    out = summary.filter(F.col("distinct_events") >= min_events).drop("distinct_events")
    out = with_run_metadata(out, min_events, as_of)
    # a distributed sort: under AQE its range sampling reads the already
    # materialised aggregate outputs, so it costs no extra pass
    return out.orderBy(*by) if sort else out


def group_size_distribution(counts: DataFrame, col: str = "distinct_events") -> DataFrame:
    """Mean, median and p95 of group sizes (a global aggregate over groups)."""
    x = F.col(col)
    return counts.agg(
        F.avg(x).alias("avg_events"),
        F.percentile_approx(x, 0.5).alias("median_events"),
        F.percentile_approx(x, 0.95).alias("p95_events"),
    )
