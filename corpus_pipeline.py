"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. ``toxicity`` — documents that operator 5 predicts as toxic go.
2. ``simhash`` — one document of each near-duplicate component of operator 7 stays (the smallest id).
3. ``decontamination`` — documents that operator 9 finds contaminated by ``benchmark`` go.
4. ``mixing`` — operator 4 sets how often each document is taken; a row stands for every (started) epoch that takes it.
5. ``sharding`` — operator 2 cuts the mix into contiguous shards of equal size; adds ``size``, ``text_crc32``, ``shard``, ``slot``.

Every stage keeps the columns of ``documents``, also extra ones, whatever their names; the last one's new columns
replace input columns of the same name.  Null and empty texts are not toxic, not contaminated, near-duplicates of each other,
and hold no words to mix, so none is left after stage 4.  An empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm import contamination, mixing, sharding, simhash, toxicity
from lakemart.llm.common import load, scratch_scope
from lakemart.llm.queries import N_SHARDS, held_out
from lakemart.session import Scratch, materialize

_USED = ("doc_id", "text", "lang", "source")


def _apart(docs: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fn`` over ``docs`` with the columns it does not use under neutral names, so none clashes with its own."""
    neutral = {c: c if c in _USED else f"_doc_col_{i}" for i, c in enumerate(docs.columns)}
    out = fn(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in neutral.items())))
    new = [c for c in out.columns if c not in neutral.values()]
    fresh = {c.lower() for c in new}
    return out.select(*(F.col(n).alias(c) for c, n in neutral.items() if c.lower() not in fresh), *new)


def _same(docs: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return _apart(docs, lambda d: fn(d).select(*d.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return _same(docs, lambda d: toxicity.score_documents(d, model).where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _same(docs, lambda d: simhash.drop_near_duplicates(d, simhash.SHINGLE, simhash.MAX_BITS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bench = load(spark, sf_dir, "benchmark")
    return _same(docs, lambda d: contamination.contaminated(d, bench).where("not contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _same(docs, lambda d: mixing.mixed_rows(mixing.mix(d)))


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _apart(docs, lambda d: sharding.assign_shards(d, N_SHARDS))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; work tables and the stages before the last one are dropped as soon as the next stage is written."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        kept = Scratch(spark)
        with scratch_scope(spark):
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", kept)
        if before:
            before.release()
        before = kept
    return docs


#: SQL cannot express the learnt and the graph stages; the tests hold run() against a brute-force version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
