"""Positional (row-number) alignment of keyless files — J01 and its audit D06.

Row *i* of file A is paired with row *i* of file B.  Spark gives no global
row number for free, and ``monotonically_increasing_id`` encodes
(partition, offset), so equal partition *counts* on both sides do not give
equal ids.  The ordinal here is exact for any split layout:

1. Tag each row with its input split (``_metadata.file_path`` /
   ``file_block_start``) and ``monotonically_increasing_id`` — rows of one
   split are contiguous inside one task, so ``id - min(id)`` is the row's
   index in its split — and write the tagged rows once, as Parquet, to the
   shared checkpoint folder.  From here on the tags are stored values: a
   later pass that splits or packs the input differently (executors lost,
   different parallelism) cannot change them, and the text is parsed once.
   The row count is observed on that same write.
2. Aggregate one row per split (count, min id); exclusive running sums inside
   each file (by start) and over the files (one row per file, the only
   unpartitioned step) give every split its offset.
3. Join the split table back — Spark broadcasts it if its written size is
   under the broadcast threshold and shuffles otherwise — and compute
   ``ordinal = offset + id - min(id)``.

The positional join itself stores no copy of its sides (:func:`pinned_index`).  A first scan reads no column: it counts the rows of each
split and notes the first id, and the offsets (one row per split) are all that is written.  The second scan, inside the join, tags the rows
again.  Its ids agree as long as the input is packed into the same partitions, and every row proves it: its id must
lie in ``[first id, first id + rows)`` of its split.  As the ids of a scan are distinct and there are no more rows than places,
each place is then taken once and in order.  A plan that differs (other split settings, other parallelism, changed files) fails with an error
that says so, never with a shifted row.

The two sides are equi-joined on the ordinal after checking that their
row counts (observed on the first scan) are equal.  Both sides are dealt by
ordinal into as many partitions as they have input splits (at least
``spark.sql.shuffle.partitions``), so a task of the join gets about one split of
each side at any size.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window, functions as F
from pyspark.sql.types import LongType

from lakemart.operators.schema import drop_overlap
from lakemart.session import Scratch, materialize

_FP, _BS, _MID, _N, _M0, _OFF = "_lm_fp", "_lm_bs", "_lm_mid", "_lm_n", "_lm_m0", "_lm_off"


class PositionalMismatch(ValueError):
    """The two inputs of a positional join do not have the same row count."""


@dataclass
class Indexed:
    """A side with its row ordinal, its row count and its number of input splits."""
    df: DataFrame
    rows: int
    splits: int


def ordinal_index(df: DataFrame, name: str = "_idx", scope: Scratch | None = None) -> Indexed:
    """Add a 0-based dense row ordinal in file order.

    ``df`` must be a file-source DataFrame as read (it must expose the hidden
    ``_metadata`` column); read each side with ``multiLine`` off so that a
    split boundary never falls inside a record.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    obs = Observation("ordinal_rows")
    tagged = materialize(df.select(*cols,
                                   F.col("_metadata.file_path").alias(_FP),
                                   F.col("_metadata.file_block_start").alias(_BS),
                                   F.monotonically_increasing_id().alias(_MID))
                         .observe(obs, F.count(F.lit(1)).alias("rows")),
                         "indexed-rows", scope)
    blocks, _, splits = _offsets(tagged, scope)
    out = (tagged.join(blocks, [_FP, _BS])
           .select(*cols, (F.col(_OFF) + F.col(_MID) - F.col(_M0)).cast(LongType()).alias(name)))
    return Indexed(out, int(obs.get["rows"]), splits)


def _offsets(tagged: DataFrame, scope: Scratch | None) -> tuple[DataFrame, int, int]:
    """One row per split (first id, rows, rows before it), the rows and the splits of all; one job."""
    per_split = tagged.groupBy(_FP, _BS).agg(F.count(F.lit(1)).alias(_N), F.min(_MID).alias(_M0))
    inside = Window.partitionBy(_FP).orderBy(_BS).rowsBetween(Window.unboundedPreceding, -1)
    files = Window.orderBy(_FP).rowsBetween(Window.unboundedPreceding, -1)
    before = per_split.groupBy(_FP).agg(F.sum(_N).alias("_lm_t")).select(
        _FP, F.coalesce(F.sum("_lm_t").over(files), F.lit(0)).alias("_lm_f"))
    seen = Observation("splits")
    blocks = materialize(per_split.withColumn("_lm_in", F.coalesce(F.sum(_N).over(inside), F.lit(0))).join(before, _FP)
                         .select(_FP, _BS, _M0, _N, (F.col("_lm_f") + F.col("_lm_in")).cast(LongType()).alias(_OFF))
                         .observe(seen, F.sum(_N).alias("rows"), F.count(F.lit(1)).alias("splits")),
                         "split-offsets", scope)
    got = seen.get
    return blocks, int(got["rows"] or 0), int(got["splits"])


def pinned_index(df: DataFrame, name: str = "_idx", scope: Scratch | None = None) -> Indexed:
    """The same ordinal without a stored copy: a scan without columns counts the splits, the returned plan reads ``df`` once more.

    Run it in the same session and under the same split settings; a row whose split is packed differently by then raises."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    tags = [F.col("_metadata.file_path").alias(_FP), F.col("_metadata.file_block_start").alias(_BS), F.monotonically_increasing_id().alias(_MID)]
    blocks, rows, splits = _offsets(df.select(*tags), scope)
    place = F.col(_MID) - F.col(_M0)
    moved = F.raise_error(F.lit("positional join: the input is split differently than when its rows were counted; run it again")).cast(LongType())
    ordinal = F.when((place >= 0) & (place < F.col(_N)), F.col(_OFF) + place).otherwise(moved)
    return Indexed(df.select(*cols, *tags).join(blocks, [_FP, _BS], "left").select(*cols, ordinal.cast(LongType()).alias(name)), rows, splits)


def with_ordinal(df: DataFrame, name: str = "_idx") -> DataFrame:
    """``ordinal_index`` without the counts."""
    return ordinal_index(df, name).df


def zip_by_position(left: DataFrame, right: DataFrame,
                    expected_overlap: Iterable[str] | None = None,
                    prepare=None, scope: Scratch | None = None) -> DataFrame:
    """Pair row *i* of ``left`` with row *i* of ``right`` (both as read from files).

    Each side may be one file or a folder; rows are numbered in
    lexicographic path order, then by position inside each file (so a
    folder written by Spark — ``part-00000…`` — keeps its write order).
    Records must not span lines (``multiLine`` off); blank lines are skipped
    by the reader, which the equal-count check would expose.

    ``prepare`` (optional) is applied to each side after indexing (e.g.
    ``lower_names``).  Columns of ``right`` that ``left`` also has are dropped
    (``expected_overlap`` guards against surprises).  Unequal row counts raise
    :class:`PositionalMismatch` — an inner join would otherwise silently lose
    or mispair rows.  The tagged copies of both sides go with ``scope``.
    """
    idx = "_lm_idx"
    # the two counting passes are independent jobs: submit them together so
    # neither side's tasks wait for the other's
    with ThreadPoolExecutor(max_workers=2) as pool:
        futures = [pool.submit(pinned_index, side, idx, scope) for side in (left, right)]
        lft, rgt = (f.result() for f in futures)
    if lft.rows != rgt.rows:
        raise PositionalMismatch(f"positional join needs equal row counts: {lft.rows} vs {rgt.rows}")
    parts = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), lft.splits, rgt.splits)
    lft, rgt = (x.df if prepare is None else prepare(x.df) for x in (lft, rgt))
    rgt = drop_overlap(lft, rgt, expected=None if expected_overlap is None else list(expected_overlap),
                       keep=[idx])
    return lft.repartition(parts, idx).join(rgt.repartition(parts, idx), idx, "inner").drop(idx)


def positional_audit(df: DataFrame, present_vs_value: Mapping[str, str], present_code=1) -> DataFrame:
    """Count rows marked absent that nevertheless carry a value.

    ``present_vs_value`` maps a presence-flag column to the value column it
    governs.  One aggregation pass; a correct alignment gives all zeros.
    """
    aggs = [F.sum(F.when((F.col(p) != F.lit(present_code)) & F.col(v).isNotNull(), 1).otherwise(0))
            .cast(LongType()).alias(f"{v}_inconsistent")
            for p, v in present_vs_value.items()]
    return df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
