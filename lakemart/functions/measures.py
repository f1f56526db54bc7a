"""Aggregate measures used by the reports (all algebraic → partial + final)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, LongType

from lakemart.functions.casts import _as_col
from lakemart.functions.numeric import rounded


def n() -> Column:
    """``COUNT(*)``."""
    return F.count(F.lit(1))


def n_of(col) -> Column:
    """``COUNT(col)`` — non-NULL values only."""
    return F.count(_as_col(col))


def mean(col, scale: int | None = 1, as_double: bool = False) -> Column:
    """NULL-skipping average, rounded to ``scale`` decimals (None = unrounded)."""
    c = _as_col(col)
    if as_double:
        c = c.cast(DoubleType())
    m = F.avg(c)
    return rounded(m, scale) if scale is not None else m


def count_where(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)`` as BIGINT (NULL predicate → 0)."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast(LongType())


def share_where(pred: Column, scale: int | None = 1) -> Column:
    """Percentage of rows (denominator ``COUNT(*)``) where ``pred`` is true, as double."""
    pct = F.lit(100.0) * count_where(pred) / n()
    return rounded(pct, scale) if scale is not None else pct
