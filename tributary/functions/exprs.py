"""Small column helpers used across layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den`` as DOUBLE, ``default`` when the denominator is 0 or NULL.

    ANSI mode raises on division by zero, so the guard is explicit.
    """
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def count_when(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (BIGINT, 0 on no match)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def fence(df: DataFrame) -> DataFrame:
    """Pass every row through a one-element generator.

    Later filters on these columns stay above the generator instead of being
    pushed beneath it (where the optimizer would substitute, and re-evaluate,
    the expressions that defined them).  Used after costly per-record
    expressions (JSON parsing, rule checks) that downstream code filters on.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
