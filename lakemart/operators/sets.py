"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def stack_periods(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name (bag semantics); schemas must already agree."""
    if not frames:
        raise ValueError("nothing to stack")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), frames)
