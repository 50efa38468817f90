"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column | str, digits: int = 3) -> Column:
    """Half-up (away from zero) rounding of the printed value to ``digits``
    decimals; null, infinite and NaN values stay as they are."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x, digits).cast("double")


def safe_ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """``scale * num / den``; null when the denominator is 0 or null."""
    return F.when(den != 0, num.cast("double") * F.lit(scale) / den.cast("double"))
