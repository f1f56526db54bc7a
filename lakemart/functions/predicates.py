"""Row filters composed from simple predicates (all pushed to the scan when possible)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, functions as F


def all_of(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def eligible(present: Iterable[str] = (), positive: Iterable[str] = (),
             not_null: Iterable[str] = (), between: Mapping[str, tuple] | None = None,
             isin: Mapping[str, Iterable] | None = None,
             not_equal: Mapping[str, object] | None = None,
             equal: Mapping[str, object] | None = None,
             present_code=1) -> Column:
    """Conjunction of: presence flags = ``present_code``, grades > 0,
    IS NOT NULL, BETWEEN (inclusive), IN lists, ``!=`` (NULL drops the row)
    and equality.  Each clause is a plain comparison so Parquet can take it.
    """
    preds = [F.col(c) == F.lit(present_code) for c in present]
    preds += [F.col(c) > F.lit(0) for c in positive]
    preds += [F.col(c).isNotNull() for c in not_null]
    preds += [F.col(c).between(lo, hi) for c, (lo, hi) in (between or {}).items()]
    preds += [F.col(c).isin(list(v)) for c, v in (isin or {}).items()]
    preds += [F.col(c) != F.lit(v) for c, v in (not_equal or {}).items()]
    preds += [F.col(c) == F.lit(v) for c, v in (equal or {}).items()]
    return all_of(preds)
