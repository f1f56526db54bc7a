"""Operator 7 — SimHash near-duplicates by pigeonhole blocks.

Fingerprint: A-Z lower-cased, words = runs of non-white-space, shingles of three
words joined by a space (fewer words: the whole sequence; repeats count), each
hashed by XXH64 (UTF-8, seed 42); a bit is 1 if set in over half the hashes; no words: zero.

Two fingerprints link at ``max_bits`` = 3 or fewer differing bits.  All further
work is on *distinct* fingerprints, so a group of exact copies is one row:

1. Cut the 64 bits into 5 blocks.  Three differing bits touch at most three
   blocks, so a linked pair agrees on at least two: it meets in one of the
   10 tables keyed by two blocks (25 or 26 bits).
2. A bucket of one key of up to :data:`BUCKET` fingerprints is solved in a task: a
   search over Hamming distances that visits each fingerprint once and emits
   one edge per linked fingerprint (to the smallest of its part), never all pairs.
3. A larger bucket is cut again by the same rule on its remaining bits: 6 blocks of them, agreeing on
   three (level 2), then 7 blocks agreeing on four (level 3).  At level 3 at
   most 10 bits are free, so a bucket holds at most 1,024 distinct fingerprints: the
   bound is proven and nothing is dropped.
4. Components of the edges: alternating large-star and small-star steps, each written to
   the shared scratch folder, until the edges no longer change.

Defined cases: null and empty texts have fingerprint zero and link to each other and to
near-zero fingerprints; repeated rows belong to the same component; rows without id count
in a component but do not name it (``component_id`` is the smallest id present, null
if there is none); an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import map_arrow, materialize, own_names

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Distinct fingerprints that one task compares with each other.
BUCKET = 4096
#: Blocks that must agree at each level; the free bits are cut into so many blocks more as bits may differ.
AGREE = (2, 3, 4)
#: With more differing bits, three levels would not bound a bucket.
MOST_BITS = 4
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = text.encode().lower().split() if text else []       # bytes: folds A-Z, splits at ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends.tolist()
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[last:])], ">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        ones += np.unpackbits(hashes[i:i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_key`` (a hash of the text, to find the row again) and ``fp`` (64 bits as a signed long)."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "text_key", "fp"])

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    return map_arrow(keyed, run, f"doc_id {id_type}, text_key long, fp long")


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _masks(free: list[int], blocks: int, agree: int) -> list[tuple[int, list[int]]]:
    """(mask of the bits that must agree, bits that stay free) for each choice of blocks."""
    cut = [list(x) for x in np.array_split(free, blocks)]
    out = []
    for chosen in combinations(range(blocks), agree):
        mask = sum(1 << int(bit) for c in chosen for bit in cut[c])
        out.append((mask, [int(bit) for c in range(blocks) if c not in chosen for bit in cut[c]]))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bucket_edges(distinct: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges (``a``, ``b``) with ``b`` < ``a`` that connect exactly the linked fingerprints of ``distinct`` (``fp``)."""
    if not 0 <= max_bits <= MOST_BITS:
        raise ValueError(f"at most {MOST_BITS} bits may differ")
    edges = []
    # (path of masks so far: as one column ``mask``, the union of the bits agreed on)
    todo = distinct.select("fp", F.lit(0).cast("long").alias("mask"))
    groups = {0: list(range(64))}                  # agreed mask -> free bits
    for level, agree in enumerate(AGREE):
        blocks = agree + max_bits
        choices = F.create_map(*(x for mask, free in groups.items() for x in (
            F.lit(_signed(mask)), F.array(*(F.lit(_signed(mask | m)) for m, _ in _masks(free, blocks, agree))))))
        groups = {mask | m: f for mask, free in groups.items() for m, f in _masks(free, blocks, agree)}
        keyed = (todo.select("fp", F.explode(choices[F.col("mask")]).alias("mask"))
                 .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key")))
        if level:
            keyed = keyed.distinct()               # the same bits can be agreed on by several paths
        counts = materialize(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
        last = level == len(AGREE) - 1
        largest = counts.agg(F.max("n")).first()[0] or 0
        small = keyed.join(counts if last else counts.where(F.col("n") <= bucket), ["mask", "key"])
        lists = small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
        edges.append(materialize(map_arrow(lists.select("fps"), _solve(max_bits), "a long, b long").distinct(), "simhash-edges"))
        if last or largest <= bucket:
            break
        todo = materialize(keyed.join(counts.where(F.col("n") > bucket), ["mask", "key"]).select("fp", "mask"), "simhash-large")
    out = edges[0]
    for e in edges[1:]:
        out = out.union(e)
    return out.distinct()


def _solve(max_bits: int):
    def solve(batches):
        for b in batches:
            pairs = [p for fps in b.column(0).to_pylist() for p in linked_parts(np.array(fps, np.int64).view(np.uint64), max_bits)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return solve


def linked_parts(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest signed fingerprint of its part) within one bucket of distinct fingerprints."""
    signed = np.sort(fps.view(np.int64))
    open_ = signed.view(np.uint64)
    out = []
    while len(open_) > 1:
        root, frontier, open_ = open_[0], open_[:1], open_[1:]
        while len(frontier) and len(open_):
            hit = np.zeros(len(open_), bool)
            for f in np.array_split(frontier, -(-len(frontier) // 256)):
                hit |= (np.bitwise_count(f[:, None] ^ open_[None, :]) <= max_bits).any(axis=0)
            frontier, open_ = open_[hit], open_[~hit]
            out += [(x, int(root.view(np.int64))) for x in frontier.view(np.int64).tolist()]
    return out


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node of its component) for every node of ``edges`` (``a`` > ``b``)."""
    e = materialize(edges.select("a", "b").distinct(), "cc")
    before = None
    while True:
        # large star: every larger neighbour of a node moves to the node's smallest neighbour
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-low")
        large = materialize(e.select(F.col("b").alias("a"), F.col("a").alias("v")).join(low, "a")
                            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "cc-large")
        # small star: a node and its smaller neighbours move to the smallest of them
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("s"))
        e = materialize(small.select(F.col("s.a").alias("a"), F.col("s.m").alias("b")).where("a <> b").distinct(), "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b"))).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``text_key``, ``fp``, ``component_id``, ``stays`` (true for one row
    key (``doc_id``, ``text_key``) of each component: the smallest)."""
    f = materialize(fingerprints(docs, shingle), "simhash-fp")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    classes = materialize(f.groupBy("fp").agg(F.min(row).alias("rep")), "simhash-classes")
    roots = components(bucket_edges(classes.select("fp"), max_bits))
    rooted = materialize(classes.join(roots, classes.fp == roots.node, "left")
                         .select("fp", "rep", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    tops = materialize(rooted.groupBy("root").agg(F.min("rep").alias("top")), "simhash-tops")
    named = materialize(rooted.join(tops, "root").select("fp", "top"), "simhash-named")
    return f.join(named, "fp").select(
        "doc_id", "text_key", "fp", F.col("top.id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("top.id")) & (F.col("text_key") == F.col("top.key"))).alias("stays"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component; of equal rows (same id and text) one stays."""
    docs = own_names(docs, ["_lm_id", "_lm_text"])
    keep = materialize(near_duplicates(docs, shingle, max_bits).where("stays")
                       .select(F.col("doc_id").alias("_lm_id"), F.col("text_key").alias("_lm_text")).distinct(), "simhash-keep")
    keyed = docs.withColumn("_lm_text", text_key(F.col("text"))).withColumn("_lm_id", F.col("doc_id"))
    # null-safe: rows without id can stay too.  The join already deals rows by the key, so dropDuplicates adds no shuffle
    same = keyed["_lm_id"].eqNullSafe(keep["_lm_id"]) & (keyed["_lm_text"] == keep["_lm_text"])
    return keyed.join(keep, same, "left_semi").dropDuplicates(["_lm_id", "_lm_text"]).drop("_lm_id", "_lm_text")
