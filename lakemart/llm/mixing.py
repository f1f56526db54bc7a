"""Operator 4 — mix sources to target weights.

Native DataFrame code only.  Every document gets a hash-random key (MD5 of a
seed and its id, so reruns agree); documents are range-sorted by (source,
key), so a source with a third of all rows spreads over many partitions;
distributed prefix sums of the word counts (:mod:`lakemart.llm.prefix`) give
each document its place in its source; the source's budget is cut exactly.

Budgets: all sources together get the words of the corpus, shared by weight.
A source's target stops at ``max_epochs`` times its own words; what it cannot
use is reshared by weight among the rest until none is above.  This is a
water level ``L``: target = min(cap, weight * L).  With the sources sorted by
cap / weight, the capped ones are the first ``k``, where ``k`` is the smallest
number whose level ``(T - caps) / (W - weights)`` of the rest does not exceed the next ratio.

A document of ``size`` words is taken ``e`` times whole (``e`` = full epochs of
its source) plus the words of the last, partial epoch that fall on it; only the one
document at the cut of each source is taken in part.

Defined cases: null text: size 0, nothing taken; null source: a source of its
own, last in order; repeated rows count each on their own; ids that tie are
ordered by size and CRC, beyond which rows are interchangeable; an empty table
or a corpus without words gives targets 0.  Other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakemart.llm.common import materialize, own_names, text_crc32, word_count
from lakemart.llm.prefix import PART, prefix_sums, range_parts

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1:"
_WORK = ["size", "source_size", "target", "taken", "_lm_key", "_lm_src", "_lm_before", "_lm_crc", "_lm_budget", PART]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    The windows here run over one row per source, not over documents.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("_rank", F.row_number().over(by_name) - 1)
         .withColumn("_w", F.element_at(F.array(*(F.lit(x) for x in weights)), F.col("_rank") % len(weights) + 1))
         .withColumn("_cap", F.col("source_size") * max_epochs))
    # smallest cap per weight first; equal ratios are capped together or not at all, so their order is free
    ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    s = s.withColumns({
        "_left": F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_cap").over(ratio), F.lit(0)),
        "_w_left": F.sum("_w").over(all_rows) - F.coalesce(F.sum("_w").over(ratio), F.lit(0)),
    })
    # open: its cap exceeds its share of what the smaller caps leave; every later source is then open too
    wide = "decimal(19,0)"
    s = s.withColumn("_open", F.col("_cap").cast(wide) * F.col("_w_left").cast(wide)
                     > F.col("_w").cast(wide) * F.col("_left").cast(wide))
    first = F.min(F.when(F.col("_open"), F.struct(F.col("_cap") / F.col("_w"), "_rank", "_left", "_w_left"))).over(all_rows)
    level = F.col("_first._left"), F.col("_first._w_left")
    target = F.when(F.col("_open"), (F.col("_w") * level[0]).cast("double") / level[1]).otherwise(F.col("_cap").cast("double"))
    return s.withColumn("_first", first).select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``source``) plus ``size``, ``source_size``, ``target`` and ``taken`` (words)."""
    docs = own_names(docs, _WORK)
    return take(docs.withColumns({"size": word_count(F.col("text")), "_lm_crc": text_crc32(F.col("text"))}),
                weights, max_epochs, seed).drop("_lm_crc")


def take(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The same for rows that already carry ``size`` and ``_lm_crc`` (the text may be dropped before)."""
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = [F.asc_nulls_last("source"), F.col("_lm_key"), F.asc_nulls_first("doc_id"), F.col("size"), F.col("_lm_crc")]
    # the group of a window and the join key must not be null: a marked copy of the source
    group = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    parts = range_parts(sized.withColumn("_lm_key", key).withColumn("_lm_src", group), order, "mix")
    placed = prefix_sums(parts, order[1:], {"_lm_before": "size"}, group="_lm_src")
    # one row per source, on disk: Spark broadcasts it by its real size, and only then
    targets = materialize(source_targets(parts, weights, max_epochs).withColumn("_lm_src", group).drop("source"), "mix-targets")
    budget = F.round(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("_lm_budget div source_size")).otherwise(F.lit(0))
    rest = F.when(F.col("source_size") > 0, F.expr("_lm_budget % source_size")).otherwise(F.lit(0))
    partial = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_lm_before")))
    return (placed.join(targets.withColumn("_lm_budget", budget), "_lm_src")
            .withColumn("taken", (epochs * F.col("size") + partial).cast("long"))
            .drop("_lm_key", "_lm_src", "_lm_before", "_lm_budget", PART))


def mixed_rows(taken: DataFrame) -> DataFrame:
    """The mix as rows: a document stands once for every (started) epoch that takes it, always whole."""
    copies = F.when(F.col("taken") > 0, F.expr("(taken + size - 1) div size")).otherwise(F.lit(0)).cast("int")
    return (taken.withColumn("_lm_copies", copies).where("_lm_copies > 0")
            .withColumn("_lm_copy", F.explode(F.sequence(F.lit(1), F.col("_lm_copies"))))
            .drop("_lm_copies", "_lm_copy", "size", "source_size", "target", "taken"))
