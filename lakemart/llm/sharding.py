"""Operator 2 — contiguous shards of nearly equal byte size.

Native DataFrame code only.  Documents are ordered by id (nulls first; ties
by size and CRC, then interchangeable), global prefix sums of their sizes come
from per-partition totals (:mod:`lakemart.llm.prefix`), and the document whose
midpoint lies in the ``i``-th of ``n`` equal byte intervals goes to shard ``i``.
So every shard is one contiguous id range, and its size differs from
``total / n`` by at most one document (half a document at each of its ends).

This is the ``bytes`` law; equal texts are not kept together (a group of
copies may be larger than a shard), which the law does not ask for.

Defined cases: a null text has size ``overhead``; a null id sorts first;
repeated rows are placed like any other; an empty table gives an empty
result; with fewer documents than shards some shards stay empty (numbers are
not shifted).  Other columns are carried along; a column with a name of the result is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemart.llm.common import own_names, text_crc32, utf8_bytes
from lakemart.llm.prefix import PART, prefix_sums, range_parts

#: Bytes counted for a document besides its text.
OVERHEAD = 16
_WORK = ["shard", "slot", "size", "text_crc32", "_lm_before", "_lm_index", "_lm_one", "_lm_first", PART]


def assign_shards(docs: DataFrame, n_shards: int, overhead: int = OVERHEAD) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) plus ``size``, ``text_crc32``, ``shard`` and ``slot``
    (position inside the shard, gapless from 0)."""
    docs = own_names(docs, _WORK)
    return place(docs.withColumns({"size": utf8_bytes(F.col("text")) + overhead,
                                   "text_crc32": text_crc32(F.col("text"))}), n_shards)


def place(sized: DataFrame, n_shards: int) -> DataFrame:
    """The same for rows that already carry ``size`` and ``text_crc32`` (the text may be dropped before)."""
    order = [F.asc_nulls_first("doc_id"), F.col("size"), F.col("text_crc32")]
    parts = range_parts(sized.withColumn("_lm_one", F.lit(1).cast("long")), order, "shards")
    placed = prefix_sums(parts, order, {"_lm_before": "size", "_lm_index": "_lm_one"})
    total = parts.agg(F.sum("size")).first()[0] or 1                 # one number; the table is on disk already
    interval = F.expr(f"({n_shards} * (2 * _lm_before + size)) div {2 * total}L")
    placed = placed.withColumn("shard", F.least(interval, F.lit(n_shards - 1)).cast("int"))
    first = placed.groupBy("shard").agg(F.min("_lm_index").alias("_lm_first"))   # at most n_shards rows
    return (placed.join(F.broadcast(first), "shard")
            .withColumn("slot", F.col("_lm_index") - F.col("_lm_first"))
            .drop("_lm_before", "_lm_index", "_lm_one", "_lm_first", PART))
