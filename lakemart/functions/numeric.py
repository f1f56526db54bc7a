"""Numeric helpers: rounding, row means, safe ratios."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType

from lakemart.functions.casts import _as_col


def rounded(col, scale: int = 1) -> Column:
    """``ROUND(x, scale)`` on a double: half away from zero on ``v = x * 10^s``.

    This is the rule of the SQL engines the reports were written for
    (``round(v) / 10^s``; ``1.005`` → ``1.0``, ``-0.04`` → ``-0.0``), not
    Spark's ``round``, which rounds the decimal text of ``x`` through a
    ``BigDecimal`` per value.  ``rint`` is exact at every magnitude and rounds
    ties to even; a tie it rounded down (``|v| - rint(|v|) = 0.5``) goes up by
    one.  A value whose ``v`` is beyond the doubles is returned as it is, as the
    engines do.  Bit-identical to them, and short enough for generated code.
    """
    factor = float(10 ** scale)
    x = _as_col(col)
    v = x * F.lit(factor)
    a = F.abs(v)
    near = F.rint(a)
    magnitude = near + F.when(a - near == F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(a < F.lit(float("inf")), F.signum(v) * magnitude / F.lit(factor)).otherwise(x)


def row_mean(cols: Sequence, scale: int | None = 1) -> Column:
    """Mean across columns of one row; NULL if any input is NULL."""
    cs = [_as_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, cs)
    mean = total / F.lit(float(len(cs)))
    return rounded(mean, scale) if scale is not None else mean


def safe_ratio(part, total) -> Column:
    """``part / total`` as double; NULL when ``total`` is 0 or NULL (never throws)."""
    return F.try_divide(_as_col(part).cast(DoubleType()), _as_col(total).cast(DoubleType()))
