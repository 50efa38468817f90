"""Query registry: named queries over the test tables and their SQL oracles.

Every query reads the whole ``events`` table of a scale-factor folder (or data
Spark derives from it) through the library's operators. Outputs are
normalised the same way on both sides so that any engine can check them:
timestamps as zone-less UTC wall-clock, doubles rounded to 6 decimals by
``tie_safe_round`` (for the comparison only; the library rounds with ``round``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampType

from eventlake.session import ensure_utc

OUTPUT_DIGITS = 6

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    key: str
    fn: QueryFn
    sql: str | None = None
    doubles: tuple[str, ...] = ()


REGISTRY: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    """Normalise a result: TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock),
    DOUBLE -> rounded to 6 decimals."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = tie_safe_round(c.cast("double"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


# The comparison of two engines needs a rounding that both compute alike at
# printed ties: half away from zero with a tolerance of TIE of one output unit.
# Values too large to have the digits, and non-finite ones, stay as they are.
TIE = 1e-6
ROUND_BELOW = 1e9


def tie_safe_round(x: Column, digits: int = OUTPUT_DIGITS) -> Column:
    scale = F.lit(float(10 ** digits))
    rounded = F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5 + TIE)) / scale
    return F.when(F.abs(x) < ROUND_BELOW, rounded).otherwise(x).cast("double")


def sql_round(expr: str, digits: int = OUTPUT_DIGITS) -> str:
    """SQL text of ``tie_safe_round``."""
    scale = f"{10 ** digits}.0"
    return (f"(CASE WHEN abs({expr}) < {ROUND_BELOW:.0f} THEN sign({expr}) * floor(abs({expr}) * {scale} + {0.5 + TIE})"
            f" / {scale} ELSE {expr} END)")


def oracle_text(q: Query) -> str | None:
    """The oracle SQL with the declared double columns rounded like ``present``."""
    if q.sql is None:
        return None
    body = q.sql.strip().rstrip(";")
    if not q.doubles:
        return body
    repl = ", ".join(f'{sql_round(f"q.{_qi(c)}")} AS {_qi(c)}' for c in q.doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) AS q"


def _qi(name: str) -> str:
    return name if re.fullmatch(r"[a-z_][a-z0-9_]*", name) else f'"{name}"'


def register(key: str, sql: str | None = None, doubles: tuple[str, ...] = ()):
    """Register ``fn`` under ``key`` with its oracle SQL; the registered
    callable sets UTC and normalises the output with ``present``."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return present(fn(spark, sf_dir.rstrip("/")))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[key] = Query(key, run, sql, tuple(doubles))
        return run

    return deco
