import re
import zlib
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from helpers import documents, empty
from lakemart.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shards_are_contiguous_balanced_and_gapless(spark):
    docs = documents(spark)
    got = sharding.assign_shards(docs, 7).select("doc_id", "text", "size", "text_crc32", "shard", "slot").collect()
    assert len(got) == docs.count()
    assert all(r["size"] == len((r.text or "").encode()) + 16 and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in got)
    got.sort(key=lambda r: (r.shard, r.slot))
    keys = [(r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in got]
    assert keys == sorted(keys)
    by, total, before = defaultdict(list), sum(r["size"] for r in got), 0
    for r in got:
        by[r.shard].append(r.slot)
        assert r.shard == min(6, 7 * (2 * before + r["size"]) // (2 * total))
        before += r["size"]
    assert all(v == list(range(len(v))) for v in by.values())
    assert sharding.assign_shards(empty(spark), 7).count() == 0


def test_sharding_is_native_and_keeps_other_columns(spark):
    docs = documents(spark)
    out = sharding.assign_shards(docs, 7)
    assert {"lang", "source", "n_chars", "score", "shard"} <= set(out.columns) and dict(out.dtypes)["shard"] == "int"
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def brute_targets(sizes: dict, weights=(1, 2, 3), epochs=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = Fraction(sum(sizes.values())), {}, set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * level >= epochs * sizes[s]}
        if not over:
            target |= {s: w[s] * level for s in open_}
            break
        for s in over:
            target[s] = Fraction(epochs * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def test_mix_meets_water_filled_targets(spark):
    docs = documents(spark)
    got = mixing.mix(docs).select("doc_id", "text", "source", "size", "source_size", "target", "taken").collect()
    assert len(got) == docs.count()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["size"] == len(WORD.findall(r.text or "")) and 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - float(want[r.source])) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = mixing.mix(docs.repartition(3)).groupBy("doc_id", "text").agg(F.sum("taken")).collect()
    first = mixing.mix(docs).groupBy("doc_id", "text").agg(F.sum("taken")).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, first))
    partial = [r for r in got if r["size"] and r.taken % r["size"]]
    assert len(partial) <= len(sizes)                   # only the document at the cut of each source


def test_targets_of_many_sources_and_of_none(spark):
    sizes = {f"s{i:02d}": (i * 37) % 101 for i in range(30)} | {None: 5, "big": 100_000}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    want = brute_targets(sizes)
    for r in mixing.source_targets(df).collect():
        assert abs(r.target - float(want[r.source])) < 1e-6, r
    assert mixing.mix(empty(spark)).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(none).collect()] == [(0.0, 0), (0.0, 0)]


def test_mixed_rows_repeat_whole_documents(spark):
    out = mixing.mix(documents(spark))
    rows = mixing.mixed_rows(out).groupBy("doc_id", "text").count().collect()
    want = defaultdict(int)
    for r in out.collect():
        if r.taken:
            want[r.doc_id, r.text] += -(-r.taken // r["size"])
    assert {(r.doc_id, r.text): r["count"] for r in rows} == want
