"""Time helpers: dates, partition columns, hour keys and ISO text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
HOUR_KEY_FORMAT = "yyyy/MM/dd/HH"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_date(df: DataFrame, col: str = "timestamp", name: str = "event_date") -> DataFrame:
    """Adds the UTC date of ``col``."""
    return df.withColumn(name, F.to_date(_c(col)))


def with_time_parts(df: DataFrame, col: str = "timestamp", prefix: str = "") -> DataFrame:
    """Adds INT ``year, month, day, hour`` of ``col`` (the lake partition keys)."""
    c = _c(col)
    return (
        df.withColumn(f"{prefix}year", F.year(c))
        .withColumn(f"{prefix}month", F.month(c))
        .withColumn(f"{prefix}day", F.dayofmonth(c))
        .withColumn(f"{prefix}hour", F.hour(c))
    )


def hour_key(c: Column | str) -> Column:
    """``YYYY/MM/DD/HH`` text of a timestamp (the history folder key)."""
    return F.date_format(_c(c), HOUR_KEY_FORMAT)


def iso_text(c: Column | str) -> Column:
    """Timestamp -> ISO-8601 text with microseconds and a ``+00:00`` offset.

    Only for JSON/CSV edges; storage keeps real timestamps.
    """
    return F.date_format(_c(c), ISO_FORMAT)


def day_predicate(day: str, col: str = "timestamp", partitioned: bool = False) -> Column:
    """Predicate selecting one UTC day.

    On the timestamp it becomes a pushed range; with ``partitioned`` the
    ``year/month/day`` partition columns are constrained too, so whole folders
    are pruned before any file is opened.
    """
    y, m, d = (int(x) for x in day.split("-"))
    pred = F.to_date(_c(col)) == F.lit(day).cast("date")
    if partitioned:
        pred = pred & (F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d)
    return pred
