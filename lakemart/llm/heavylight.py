"""Operator 11 — documents that share most of their word n-grams: a size-aware heavy-light set join.

A document's set: its distinct word shingles (A-Z lower-cased; with fewer words than a shingle has, the whole sequence), as 64-bit
hashes.  Two sets link when ``percent``\\ % of their union is in both: sets of sizes n <= m link when they share
``need(n, m) = ceil(percent * (n + m) / (100 + percent))`` elements.  Equal sets are one class, and all work is on classes.

* **Light sets** (size up to a boundary x).  For each pair of sizes (n, m) that can link, a set of size n or m enumerates its subsets of the
  fixed size ``need(n, m)``.  Sets with a common subset share enough: no pair is checked and none is emitted, each set links to
  one set of the smaller size under its key.
* **Heavy sets** are found by scanning inverted lists.  Elements stand in one order for all sets: rare before frequent
  (:data:`FREQUENT` elements that batches of the corpus show most often come last, the order among the others is that of their hashes).
  Linked sets share an element among their first few, so only those are listed; sizes and places must also allow a link.
  Light sets large enough for a heavy partner are listed too.
* **The boundary** is the x of the least cost, from the histogram of set sizes: subsets enumerated by the light sets against elements listed and
  moved for the check of the heavy ones.

*No pairs within a group.*  First every listed class is compared with the leaders of two of its lists, and links found
give parts.  The second scan drops lists whose classes are all of one part; in the others, only classes outside the list's largest part meet the rest of
it, and only classes of different parts become candidates.  So a group of near copies costs one comparison per member, and no link between
different parts is lost.  A candidate is first judged by sketches (512 bits in the lists, then a bit per element; the bits in which they differ are a lower bound of the elements
that only one set has), and what is left on the two whole sets, hashed again from one text of each class.

Statistics (sizes, frequent elements) cover all documents; nothing is capped: the table of frequent elements only sets the order.

Defined cases: null, empty and blank texts have no set and link with nothing, their component is their own id; repeated rows are of one
class; a null id does not name a component (``component_id`` is the smallest id present, null if there is none); texts of any length are
taken whole; an empty table gives an empty result; columns of the input besides ``doc_id`` and ``text`` are not carried, whatever their names.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.llm.common import map_arrow, materialize, shuffle_cleanup
from lakemart.llm.simhash import components

SHINGLE = 4
PERCENT = 85
#: Elements put last in the order of the lists (bounds what is sent to every task: 16 bytes each).
FREQUENT = 1 << 16
#: An element is frequent for a batch if this share of its sets has it.
SHARE = 0.0025
#: The largest boundary considered.
LARGEST_LIGHT = 24
#: 64-bit words of the small sketch that the scan of the lists compares.
MARKS = 8
#: Bytes of text hashed at once (a longer text alone).
_CHUNK = 1 << 18

_U = np.uint64
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FOLD = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))
#: A random odd number for each byte (A-Z as a-z), and the base of the places in a word.
_BYTE = (np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1))[_FOLD]
_BASE = 0xD1342543DE82EF95
_power = [np.ones(1, _U)]


def need(n: int, m: int, percent: int = PERCENT) -> int:
    """Elements that sets of these sizes must share to link."""
    return -(-percent * (n + m) // (100 + percent))


def listed(n: int, percent: int = PERCENT) -> int:
    """Elements of a set of size n among which a linked set of the same size or a larger one has one, if that set lists :func:`listed` too."""
    return n - -(-percent * n // 100) + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _powers(n: int) -> np.ndarray:
    if len(_power[0]) < n:
        p = np.full(2 * n, _BASE, _U)
        p[0] = 1
        _power[0] = np.cumprod(p)
    return _power[0]


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of the texts that begin at ``starts`` in ``data``."""
    full = ~_SPACE[data]
    begin = full.copy()
    begin[1:] &= ~full[:-1]
    inner = starts[(starts > 0) & (starts < len(data))]
    begin[inner] = full[inner]                                      # a text never continues the word before it
    at = np.flatnonzero(begin)
    if not len(at):
        return np.zeros(0, _U), at
    first = (np.cumsum(full) - 1)[at]                               # places among the bytes of words
    length = np.diff(first, append=np.count_nonzero(full))
    place = np.arange(length.sum()) - np.repeat(first, length)
    h = np.add.reduceat(_BYTE[data[full]] * _powers(int(length.max()))[place], first)
    return _mixed(h), np.searchsorted(starts, at, "right") - 1


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE):
    """The sorted distinct shingle hashes of each text of a column."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + _CHUNK, "right")) - 1)
        yield from _chunk_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi] - offsets[lo], shingle)
        lo = hi


def _chunk_sets(data: np.ndarray, starts: np.ndarray, shingle: int):
    words, text = _word_hashes(data, starts)
    edge = np.searchsorted(text, np.arange(len(starts) + 1))
    long_ = _joined(words, shingle)
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        s = np.sort(long_[a:b - shingle + 1] if b - a >= shingle else _joined(words[a:b], b - a) if b > a else words[:0])
        yield s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) > 1 else s


def _joined(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k words in a row."""
    out = np.full(max(0, len(words) - k + 1), k, _U)
    for i in range(k if len(out) else 0):
        out = _mixed(out + words[i:len(words) - k + 1 + i])
    return out


def set_id(elements: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(elements.tobytes(), len(elements))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


# --- statistics: sizes of light sets, frequent elements ---

def _statistics(shingle: int):
    """Rows (kind, key, n): how many classes of a batch have a size, and in how many of its classes a frequent element is."""
    def run(batches):
        for b in batches:
            sets = {set_id(s): s for s in shingle_sets(b.column(0), shingle) if len(s)}
            if not sets:
                continue
            size, classes = np.unique([len(s) for s in sets.values()], return_counts=True)
            all_ = np.sort(np.concatenate(list(sets.values())))
            at = np.flatnonzero(np.concatenate([[True], all_[1:] != all_[:-1]]))
            element, count = all_[at], np.diff(at, append=len(all_))
            often = count >= max(4, SHARE * len(sets))
            rows = ((0, size, classes), (1, element[often].view(np.int64), count[often]))
            for kind, key, n in rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["kind", "key", "n"])
    return run


def subsets(n: int, percent: int, x: int) -> int:
    """Subsets that a light set of size n enumerates under the boundary x."""
    from math import comb
    return sum(comb(n, need(n, m, percent)) for m in range(1, x + 1) if need(n, m, percent) <= min(n, m))


def boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The largest light size, by cost: a row per enumerated subset, against a row per listed element and half a row per element moved for a check."""
    heavy = {n: c * (listed(n, percent) + n / 2) for n, c in sizes.items()}

    def cost(x: int) -> float:
        light = sum(c * subsets(n, percent, x) for n, c in sizes.items() if n <= x)
        return light + sum(h for n, h in heavy.items() if 100 * n >= percent * (x + 1))
    return min(range(LARGEST_LIGHT + 1), key=cost)


# --- sets: one row per document, with what its class lists and enumerates ---

def _subset_keys(elements: np.ndarray, percent: int, x: int) -> tuple[list[int], list[int]]:
    """Keys of the subsets of a light set: as the smaller (or equal) set of a pair of sizes, and as the larger."""
    n, low, high = len(elements), [], []
    for m in range(1, x + 1):
        c = need(n, m, percent)
        if c > min(n, m):
            continue
        tag = min(n, m) << 8 | max(n, m)
        keys = [_signed(xxhash.xxh64_intdigest(elements[list(s)].tobytes(), tag)) for s in combinations(range(n), c)]
        (low if n <= m else high).extend(keys)
    return low, high


def _sets(shingle: int, percent: int, x: int, frequent):
    def run(batches):
        last, rank = frequent.value
        seen: set[int] = set()                                   # classes already listed by this task
        for b in batches:
            size, ids, first, low, high, bits, marks = [], [], [], [], [], [], []
            for s in shingle_sets(b.column(2), shingle):
                n, key = len(s), set_id(s)
                size.append(n)
                ids.append(_signed(key) if n else None)
                own = n and key not in seen
                seen.add(key)
                lows, highs = _subset_keys(s, percent, x) if own and n <= x else (None, None)
                low.append(lows)
                high.append(highs)
                scanned = own and 100 * n >= percent * (x + 1)
                first.append(_in_order(s, last, rank)[:listed(n, percent)].view(np.int64) if scanned else None)
                bits.append(sketch(s) if scanned else None)
                marks.append(_parity(s, 64 * MARKS).view(np.int64) if scanned else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(size, pa.int32()), pa.array(ids, pa.int64())]
                + [pa.array(c, pa.list_(pa.int64())) for c in (first, low, high, marks)] + [pa.array(bits, pa.binary())],
                names=["doc_id", "text_key", "n", "id", "first", "low", "high", "marks", "sketch"])
    return run


def _in_order(elements: np.ndarray, last: np.ndarray, rank: np.ndarray) -> np.ndarray:
    if not len(last):
        return elements
    at = np.minimum(np.searchsorted(last, elements), len(last) - 1)
    hit = last[at] == elements
    return np.concatenate([elements[~hit], elements[hit][np.argsort(rank[at[hit]])]])


# --- light: a set links to the smallest class of the smaller size under each key ---

def _light_edges(sets: DataFrame) -> DataFrame:
    keyed = (sets.where("low is not null").select("id", F.lit(True).alias("small"), F.explode("low").alias("key"))
             .union(sets.where("high is not null").select("id", F.lit(False), F.explode("high"))))
    least = keyed.where("small").groupBy("key").agg(F.min("id").alias("b"))
    return keyed.join(least, "key").where("id <> b").select(F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b")).distinct()


# --- heavy: inverted lists of the first elements ---

_MARKS = tuple(f"m{k}" for k in range(MARKS))


def _shared(percent: int) -> Column:
    """Elements that the two sets of a row (sizes ``n`` and ``o_n``) must share."""
    return F.expr(f"({percent} * (n + o_n) + {99 + percent}) div {100 + percent}")


def _can_link(percent: int, x: int) -> Column:
    """Sizes and places of a common element (none before it) of two listed classes (one with its names prefixed by ``o_``)
    allow a link, and the pair is not a light one."""
    n, m = F.col("n"), F.col("o_n")
    most = F.least(n - F.col("i"), m - F.col("o_i"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.greatest(n, m) > x) & (most >= _shared(percent))


def _marks_allow(percent: int) -> Column:
    differ = sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"o_{m}"))) for m in _MARKS), F.lit(0))
    return differ <= F.col("n") + F.col("o_n") - 2 * _shared(percent)


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.greatest("o_id", "id").alias("a"), F.least("o_id", "id").alias("b")).distinct()


def _lists(sets: DataFrame, percent: int) -> DataFrame:
    """Listed elements (``element``, ``id``, ``n``, ``i``) whose list has another class of a size that can link."""
    rows = sets.where("first is not null").select("id", "n", F.posexplode("first").alias("i", "element"))
    w = Window.partitionBy("element").orderBy("n", "id")
    near = lambda id_, a, b: (F.col(id_) != F.col("id")) & (100 * F.least(a, b) >= percent * F.greatest(a, b))
    sided = rows.select("*", *(f("id").over(w).alias(f"{s}_id") for f, s in ((F.lag, "p"), (F.lead, "q"))),
                        *(f("n").over(w).alias(f"{s}_n") for f, s in ((F.lag, "p"), (F.lead, "q"))))
    return (sided.where(F.coalesce(near("p_id", "p_n", "n"), F.lit(False)) | F.coalesce(near("q_id", "q_n", "n"), F.lit(False)))
            .select("element", "id", "n", "i").dropDuplicates(["element", "id"]))


def _leader_pairs(lists: DataFrame, marks: DataFrame, percent: int, x: int) -> DataFrame:
    """Every listed class with the leaders of two of its lists: of its first and of its longest.

    A list's leader is the class in which the element comes first: rare elements stand before it, so this is the one that was
    changed least."""
    lead = materialize(lists.groupBy("element").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("i", "id", "n")).alias("l"))
                       .select("element", "c", *(F.col(f"l.{c}").alias(f"o_{c}") for c in ("id", "n", "i"))), "sets-leaders")
    mine = lists.join(lead, "element").where(F.col("id") != F.col("o_id")).groupBy("id", "n").agg(
        F.min(F.struct("i", "o_id", "o_n", "o_i")).alias("p"), F.max(F.struct("c", "i", "o_id", "o_n", "o_i")).alias("q"))
    pick = lambda s: F.struct(*(F.col(f"{s}.{c}").alias(c) for c in ("i", "o_id", "o_n", "o_i")))
    pairs = mine.select("id", "n", F.inline(F.array_distinct(F.array(pick("p"), pick("q"))))).where(_can_link(percent, x))
    other = marks.select(*(F.col(c).alias(f"o_{c}") for c in ("id", *_MARKS)))
    return _pairs(pairs.join(marks, "id").join(other, "o_id").where(_marks_allow(percent)))


def _open_pairs(lists: DataFrame, marks: DataFrame, parts: DataFrame, percent: int, x: int) -> DataFrame:
    """Candidates between classes of different parts: in each list, those outside its largest part against all."""
    rows = lists.join(parts, lists.id == parts.node, "left").select("element", "id", "n", "i", F.coalesce("root", "id").alias("part"))
    rows = materialize(rows, "sets-parts")
    count = rows.groupBy("element", "part").agg(F.count(F.lit(1)).alias("c"))
    mixed = count.groupBy("element").agg(F.max(F.struct("c", "part")).alias("t"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    open_ = rows.join(mixed.select("element", F.col("t.part").alias("most")), "element").join(marks, "id")
    open_ = materialize(open_, "sets-open")
    outside = open_.where("part <> most").select("element", *(F.col(c).alias(f"o_{c}") for c in ("id", "n", "i", "part", *_MARKS)))
    return _pairs(outside.join(open_, "element").where(
        (F.col("o_part") != F.col("part")) & ((F.col("part") == F.col("most")) | (F.col("o_id") < F.col("id")))
        & _can_link(percent, x) & _marks_allow(percent)))


# --- sketches: a lower bound of the difference of two sets ---

def sketch(elements: np.ndarray) -> bytes:
    """For each value of the elements' low bits, whether an odd number of them has it; about a bit per element."""
    return _parity(elements, 1 << max(6, (len(elements) - 1).bit_length())).tobytes()


def _parity(elements: np.ndarray, size: int) -> np.ndarray:
    return np.packbits(np.bincount((elements & _U(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1)


def least_difference(x: bytes, y: bytes) -> int:
    """Elements that are in one of two sets only, at least: the bits in which their sketches differ."""
    x, y = sorted((np.frombuffer(v, np.uint8) for v in (x, y)), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _could_link(percent: int):
    def run(batches):
        for b in batches:
            ok = [least_difference(x, y) <= n + m - 2 * need(n, m, percent) for n, m, x, y in zip(*(b.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


# --- check on whole sets ---

def _first_of_each(batches):
    seen: set[int] = set()
    for b in batches:
        new = []
        for key in b.column(0).to_pylist():
            new.append(key not in seen)
            seen.add(key)
        yield b.filter(pa.array(new, pa.bool_()))


def _whole_sets(shingle: int):
    def run(batches):
        for b in batches:
            sets = list(shingle_sets(b.column(0), shingle))
            yield pa.RecordBatch.from_arrays([pa.array([_signed(set_id(s)) for s in sets], pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "elements"])
    return run


def _member_sets(docs: DataFrame, sets: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """``id``, ``elements`` of the member classes, hashed again from one text of each."""
    texts = map_arrow(docs.select("text_key", "text"), _first_of_each, "text_key long, text string")
    keys = materialize(sets.join(members, "id", "left_semi").groupBy("id").agg(F.min("text_key").alias("text_key")).select("text_key"), "sets-members")
    whole = map_arrow(texts.join(keys, "text_key", "left_semi").select("text"), _whole_sets(shingle), "id long, elements binary")
    return whole.dropDuplicates(["id"])


def _check(percent: int):
    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``a``, ``b`` and the columns of both from ``table`` (one row per ``id``)."""
    of = lambda side: table.select(F.col("id").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", *(f"{side}_{c}" for c in columns for side in ("a", "b")))


def _linked(pairs: DataFrame, docs: DataFrame, sets: DataFrame, sketches: DataFrame, shingle: int, percent: int, name: str) -> DataFrame:
    """The pairs (``a`` > ``b``) that link: first by their sketches, what is left on the whole sets."""
    open_ = materialize(map_arrow(_both(pairs, sketches, "n", "sketch"), _could_link(percent), "a long, b long"), f"sets-{name}-open")
    members = open_.select(F.col("a").alias("id")).union(open_.select("b")).distinct()
    whole = materialize(_member_sets(docs, sets, members, shingle), f"sets-{name}-whole")
    return materialize(map_arrow(_both(open_, whole, "elements"), _check(percent), "a long, b long"), f"sets-{name}")


def similar_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_shingles`` and ``component_id``."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    with shuffle_cleanup(spark):
        stats = map_arrow(docs.select("text"), _statistics(shingle), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
        stats = materialize(stats, "sets-statistics")
        sizes = {r["key"]: r["n"] for r in stats.where((F.col("kind") == 0) & (F.col("key") <= 2 * LARGEST_LIGHT)).collect()}   # small sizes only
        often = stats.where("kind = 1").orderBy(F.desc("n"), "key").limit(FREQUENT).select("key").toPandas()["key"].to_numpy(np.int64).view(_U)
        x = boundary(sizes, percent)
        order = np.argsort(often)
        frequent = spark.sparkContext.broadcast((often[order], len(often) - order))       # more frequent, later
        id_type = docs.schema["doc_id"].dataType.simpleString()
        sets = materialize(map_arrow(docs, _sets(shingle, percent, x, frequent),
                                     f"doc_id {id_type}, text_key long, n int, id long, first array<long>, low array<long>, high array<long>, marks array<long>, sketch binary"), "sets")
        light = materialize(_light_edges(sets), "sets-light")
        lists = materialize(_lists(sets, percent), "sets-lists")
        sketches = materialize(sets.where("sketch is not null").join(lists.select("id").distinct(), "id", "left_semi")
                               .select("id", "n", "sketch").dropDuplicates(["id"]), "sets-sketches")
        check = partial(_linked, docs=docs, sets=sets, sketches=sketches, shingle=shingle, percent=percent)
        marks = materialize(sets.where("marks is not null").join(lists.select("id").distinct(), "id", "left_semi")
                            .select("id", *(F.col("marks")[k].alias(m) for k, m in enumerate(_MARKS))).dropDuplicates(["id"]), "sets-marks")
        known = light.union(check(_leader_pairs(lists, marks, percent, x), name="led"))
        parts = components(known)
        roots = materialize(components(known.union(check(_open_pairs(lists, marks, parts, percent, x), name="rest"))), "sets-roots")
        rooted = materialize(sets.join(roots, sets.id == roots.node, "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                                                                                F.coalesce("root", "id").alias("root")), "sets-rooted")
        named = materialize(rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("name")), "sets-named")
    return rooted.join(named, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id"))
