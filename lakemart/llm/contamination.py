"""Operator 9 — benchmark contamination by one Aho-Corasick automaton.

Texts and benchmark items (questions and answers alike) are normalised the same way:
A-Z lower-cased, words = runs of ASCII letters, digits and non-ASCII
characters, joined by single spaces.  Every window of 13 item words (an item of fewer
words is one window) becomes a pattern with a space on both sides, so a
match starts and ends at word bounds.  Each document is scanned once; matches are
turned into word ranges and, for documents with a hit, into character offsets
of the original text.

The patterns are read into tasks by broadcast, in slices of at most
:data:`AUTOMATON_CHARS` characters: a benchmark beyond that is scanned in as many passes of the same
pipeline stage, each with its own bounded automaton, and the matches add up.
Documents never move: the operator adds no shuffle of texts.

Defined cases: a null or empty text has no words and no hits; a null item text has no
windows; a null item id is reported as an empty string; items that share a window
are all reported; repeated documents and items count like any other; an empty
benchmark leaves every document clean.  Other columns are carried along.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from lakemart.llm.common import map_arrow, materialize, own_names

WINDOW = 13
#: Characters of patterns in one automaton.
AUTOMATON_CHARS = 8_000_000
#: Contaminated: at least one hit word, and this share of the words hit (1 in 20).
SHARE = 20
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TABLE = bytes(32 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))
_MATCH = "array<struct<item:string,first:int,last:int>>"
_WORK = ["n_words", "n_hit", "n_items", "items", "contaminated", "hit_spans", "_lm_matches"]


def words_of(text: str | None) -> list[bytes]:
    """Normalised words as UTF-8 (``bytes.lower`` folds A-Z only)."""
    return text.encode().lower().translate(_TABLE).split() if text else []


def normalised(words: list[bytes]) -> str:
    return (b" " + b" ".join(words) + b" ").decode() if words else ""


def item_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (``pattern``, ``item``) of a benchmark table (``item_id``, ``text``)."""
    def windows(batches):
        for b in batches:
            pats, items = [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(text)
                for i in range(max(1, len(w) - window + 1) if w else 0):
                    pats.append(normalised(w[i:i + window]))
                    items.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(pats, pa.string()), pa.array(items, pa.string())], names=["pattern", "item"])

    named = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return map_arrow(named, windows, "pattern string, item string").distinct()


def _automaton(patterns: dict[str, list[str]]):
    import ahocorasick
    a = ahocorasick.Automaton()
    for p, items in patterns.items():
        a.add_word(p, (len(p), p.count(" ") - 1, items))
    a.make_automaton()
    return a


def _matches(a, norm: str) -> list[tuple[str, int, int]]:
    """(item, first word, last word) of every match, overlapping matches of an item merged."""
    found = [(end - size + 1, n, items) for end, (size, n, items) in a.iter(norm)]
    if not found:
        return []
    spaces = np.flatnonzero(np.frombuffer(norm.encode("utf-32-le"), np.uint32) == 32)
    first = np.searchsorted(spaces, [x[0] for x in found]).tolist()
    by_item: dict[str, list[tuple[int, int]]] = {}
    for f, (_, n, items) in zip(first, found):
        for item in items:
            by_item.setdefault(item, []).append((f, f + n - 1))
    return [(item, f, e) for item, ranges in by_item.items() for f, e in _merged(ranges)]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for f, e in sorted(ranges):
        if out and f <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([f, e])
    return [tuple(x) for x in out]


def contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, automaton_chars: int = AUTOMATON_CHARS,
                 share: int = SHARE) -> DataFrame:
    """``docs`` (with ``text``) plus ``n_words``, ``n_hit``, ``n_items``, ``items`` (ids, sorted), ``contaminated`` and
    ``hit_spans`` (character ranges of the original text, end exclusive)."""
    docs = own_names(docs, _WORK)
    spark = docs.sparkSession
    patterns = materialize(item_windows(bench, window), "bench-windows")
    chars = patterns.agg(F.sum(F.length("pattern"))).first()[0] or 0
    slices = max(1, -(-chars // automaton_chars))
    out = docs.withColumn("_lm_matches", F.array().cast(_MATCH))
    at = out.columns.index("text")
    for k in range(slices):
        part: dict[str, list[str]] = {}
        for p, item in patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(slices)) == k).toLocalIterator():
            part.setdefault(p, []).append(item)
        out = map_arrow(out, _scan(spark.sparkContext.broadcast(part), at), out.schema)
    result = StructType(docs.schema.fields + [
        StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()),
        StructField("items", ArrayType(StringType())), StructField("contaminated", BooleanType()),
        StructField("hit_spans", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])))])
    return map_arrow(out, _judge(at, share), result)


def _scan(patterns, at: int):
    def scan(batches):
        a = _automaton(patterns.value) if patterns.value else None
        for b in batches:
            matches = b.column(b.num_columns - 1).to_pylist()
            if a is not None:
                for i, text in enumerate(b.column(at).to_pylist()):
                    found = _matches(a, normalised(words_of(text)))
                    if found:
                        matches[i] = matches[i] + [{"item": x, "first": f, "last": e} for x, f, e in found]
            kind = pa.list_(pa.struct([("item", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))
            yield pa.RecordBatch.from_arrays(b.columns[:-1] + [pa.array(matches, kind)], names=b.schema.names)
    return scan


def _judge(at: int, share: int):
    def judge(batches):
        for b in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for text, matches in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                n, hit, items, spans = len(words_of(text)), 0, [], []
                if matches:
                    ranges = _merged([(m["first"], m["last"]) for m in matches])
                    hit = sum(e - f + 1 for f, e in ranges)
                    items = sorted({m["item"] for m in matches})
                    at_words = [m.span() for m in _WORDS.finditer(text)]
                    spans = [{"start": at_words[f][0], "end": at_words[e][1]} for f, e in ranges]
                for c, v in zip(cols, (n, hit, len(items), items, hit > 0 and share * hit >= n, spans)):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_(),
                     pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            yield pa.RecordBatch.from_arrays(
                b.columns[:-1] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=b.schema.names[:-1] + ["n_words", "n_hit", "n_items", "items", "contaminated", "hit_spans"])
    return judge
