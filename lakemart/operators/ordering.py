"""Sorts, top-k and global positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from lakemart.session import Scratch, materialize


def _key(k) -> Column:
    return F.col(k) if isinstance(k, str) else k


def sorted_by(df: DataFrame, keys: Sequence) -> DataFrame:
    """Global sort (range exchange + per-partition sort)."""
    return df.orderBy(*[_key(k) for k in keys])


def top_k(df: DataFrame, by, k: int, tie_break: Sequence = (), cols: Sequence | None = None,
          ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``by`` (NULLs last), ties broken by ``tie_break``.

    Compiles to ``TakeOrderedAndProject``: each task keeps its own k best
    rows, only k × tasks rows reach the final merge.
    """
    main = _key(by)
    main = main.asc_nulls_last() if ascending else main.desc_nulls_last()
    out = df.orderBy(main, *[_key(t).asc_nulls_last() for t in tie_break])
    if cols is not None:
        out = out.select(*cols)
    return out.limit(k)


def numbered(df: DataFrame, name: str = "pos") -> DataFrame:
    """Number the rows of an already ordered *report* (a grouped or top-k result: few rows), lazily.

    The numbers follow the order the rows come in; the window runs over the
    finished report in one task.  For tables of any size use :func:`with_position`.
    """
    at = Window.orderBy("_lm_at")
    return (df.withColumn("_lm_at", F.monotonically_increasing_id())
            .withColumn(name, F.row_number().over(at).cast(LongType())).drop("_lm_at"))


def with_position(df: DataFrame, keys: Sequence, name: str = "pos", scope: Scratch | None = None) -> DataFrame:
    """Sort by ``keys`` and add the 1-based global position of each row.

    Never funnels the data into one task: the sorted rows, tagged with their
    partition and in-partition id, are written once to the shared checkpoint
    folder (so a retry cannot re-sample different range boundaries), the per-partition counts
    (one row per shuffle partition — a bound fixed by configuration) are
    turned into offsets, and each row's position is offset + index in its
    partition.  Keys should be unique for a deterministic position; a row id
    is appended as the last sort key so that even a key shared by a third
    of the rows is spread over several range partitions.  The written copy goes with ``scope``.
    """
    tagged = materialize(df.select("*", F.monotonically_increasing_id().alias("_lm_in"))
                         .orderBy(*[_key(k) for k in keys], F.col("_lm_in"))
                         .drop("_lm_in")
                         .select("*", F.spark_partition_id().alias("_lm_p"),
                                 F.monotonically_increasing_id().alias("_lm_m")),
                         "sorted-positions", scope)
    before = Window.orderBy("_lm_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = (tagged.groupBy("_lm_p")
             .agg(F.count(F.lit(1)).alias("_lm_n"), F.min("_lm_m").alias("_lm_m0"))
             .withColumn("_lm_off", F.coalesce(F.sum("_lm_n").over(before), F.lit(0))))
    out = (tagged.join(F.broadcast(parts), "_lm_p")
           .withColumn(name, (F.col("_lm_off") + F.col("_lm_m") - F.col("_lm_m0") + 1).cast(LongType()))
           .drop("_lm_p", "_lm_m", "_lm_n", "_lm_m0", "_lm_off"))
    return out
