"""3-sigma outlier detection per group (default: device type x day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.numeric import safe_ratio
from eventlake.operators.joins import join_group_stats
from eventlake.schema import DEFAULT_GROUP, OUTLIER_SIGMA


def daily_bounds(df: DataFrame, by: Sequence[str] = DEFAULT_GROUP, sigma: float = OUTLIER_SIGMA,
                 col: str = "event_duration") -> DataFrame:
    """Per group: mean, sample stddev, count and ``mean -/+ sigma * stddev``.

    A plain partial aggregate (one row per group per task is shuffled), so a
    hot group costs nothing extra. A one-row group has a null stddev and null
    bounds.
    """
    x = F.col(col)
    return (
        df.groupBy(*by)
        .agg(F.avg(x).alias("daily_mean"), F.stddev_samp(x).alias("daily_stddev"), F.count(x).alias("daily_count"))
        .withColumn("lower_bound", F.col("daily_mean") - F.lit(sigma) * F.col("daily_stddev"))
        .withColumn("upper_bound", F.col("daily_mean") + F.lit(sigma) * F.col("daily_stddev"))
    )


def flag_outliers(df: DataFrame, bounds: DataFrame, by: Sequence[str] = DEFAULT_GROUP,
                  col: str = "event_duration") -> DataFrame:
    """Adds ``is_outlier``: strictly outside the group's bounds. Null bounds
    (one-row groups) never flag a row."""
    x = F.col(col)
    joined = join_group_stats(df, bounds, by)
    return joined.withColumn(
        "is_outlier", F.coalesce((x < F.col("lower_bound")) | (x > F.col("upper_bound")), F.lit(False))
    )


def remove_outliers(df: DataFrame, by: Sequence[str] = DEFAULT_GROUP, sigma: float = OUTLIER_SIGMA,
                    col: str = "event_duration", keep_stats: bool = False) -> DataFrame:
    """Rows within ``sigma`` standard deviations of their group mean."""
    flagged = flag_outliers(df, daily_bounds(df, by, sigma, col), by, col)
    kept = flagged.filter(~F.col("is_outlier"))
    if keep_stats:
        return kept
    return kept.select(*df.columns)


def outlier_rate(flagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Outliers, total and outlier percentage (null on empty input)."""
    n_out = F.count_if(F.col("is_outlier"))
    n = F.count(F.lit(1))
    return flagged.groupBy(*by).agg(
        n_out.alias("outliers"), n.alias("total"), safe_ratio(n_out, n, 100.0).alias("outlier_pct")
    )
