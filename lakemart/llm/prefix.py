"""Distributed prefix sums in a global order, from per-partition totals.

The rows are range-partitioned on the order once and written to the shared
scratch folder with their partition number; one total per (group, partition)
gives every partition its starting value; a window inside each (group,
partition) does the rest.  No task ever sees more than one range partition,
and the only unpartitioned work is on one row per partition (a number set by
``spark.sql.shuffle.partitions``) and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.llm.common import materialize, shuffle_cleanup

PART = "_lm_part"


def range_parts(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in range partitions of ``order``, with the partition number, written once."""
    with shuffle_cleanup(df.sparkSession):
        return materialize(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()), name)


def prefix_sums(parts: DataFrame, order: list[Column], sums: dict[str, str], group: str | None = None) -> DataFrame:
    """Add, for each ``{new column: value column}``, the sum of the value over all
    earlier rows (exclusive) of the row's group in the global order.

    ``group`` must not hold nulls; rows that tie in ``order`` must be
    interchangeable (give every distinguishing column a place in the order).
    """
    keys = ([group] if group else []) + [PART]
    totals = parts.groupBy(*keys).agg(*(F.sum(v).alias(f"_t_{k}") for k, v in sums.items()))
    before = Window.orderBy(PART) if group is None else Window.partitionBy(group).orderBy(PART)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*keys, *(F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in sums))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(base, keys)
    for k, v in sums.items():
        out = out.withColumn(k, F.col(f"_b_{k}") + F.coalesce(F.sum(v).over(inside), F.lit(0)))
    return out.drop(*(f"_b_{k}" for k in sums))
