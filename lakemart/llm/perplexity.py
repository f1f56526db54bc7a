"""Operator 6 — quality rules and n-gram perplexity bands.

*Model.*  An interpolated modified Kneser-Ney model of character 5-grams per language, counted by Spark over all
documents: each task packs and sorts the n-grams of its texts and sends every distinct one once with its count
(so the shuffle is a share of the corpus, not a row per character); lower orders are continuation
counts of the distinct higher ones; discounts D1, D2, D3+ come from the counts of counts; probabilities and back-off weights are
joins from order 1 up.  A character vocabulary keeps the model of an open-ended corpus small; text is
white-space normalised, padded at the start and closed by an end symbol.

*Store.*  Entries are addressed by 64-bit hashes and stored as sorted arrays, one row per (slice, order, kind).  Orders 3 to 5
are cut into slices by the hash of the two characters before the predicted one: every look-up that a position can need
lies in one slice (orders 1 and 2 are in all of them).  A slice holds about :data:`SLICE` entries and is a folder of files below
the shared folder, written by Spark and opened by the tasks that need it: nothing of the model passes through the driver or a broadcast.
Documents never move: a task holds about :data:`HELD` bytes of texts, marks the slice of every position and opens one slice after the other,
so its memory is that of the held texts and one slice, however many slices the model has.

*Bands.*  Per language, documents whose log-perplexity is more than :data:`FENCE` times the distance between
the median and the quartile outside that quartile (each side by its own distance) are rejected (above: noise; below: repetition).

Base rules per document: words, characters in words, symbols, repeated lines, words in repeated 8-word
windows; fewer than 20 words or over 30 % repeated words fail.

Defined cases: null and empty texts have no words and fail (perplexity null); a null language is a language of its
own; a language of few documents has its own bands like any other (documents all alike: nothing is outside); a text of any length is
scored whole (one beyond :data:`HELD` is held alone); equal texts have equal scores wherever they lie, because logarithms are summed as
integers (:data:`UNIT` to one); an empty table gives an empty result.  Other columns than the text are carried along.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from lakemart.llm.common import files_by, map_arrow, materialize, materialize_by, own_names
from lakemart.sources.drift import open_uri

ORDER = 5
#: Entries of orders 3 to 5 in one slice of the model.
SLICE = 4_000_000
#: Tukey's outer fence, three interquartile ranges, with each side's own spread: the range is twice median to quartile.
FENCE = 6.0
#: Characters that one task counts, and positions it scores, at once; bytes of texts it holds while the slices pass by.
COUNTED, SCORED, HELD = 1 << 21, 1 << 18, 1 << 24
#: Logarithms are rounded to multiples of 1 / UNIT: 2**18 of them sum to exact doubles, and any number of them to integers.
UNIT = 1 << 28
MIN_WORDS, WINDOW, MAX_REPEATED = 20, 8, 30
SYMBOLS = "#*$%&|<>"
_BOS, _EOS = 2, 3
_SPACE = " \t\n\r\x0b\x0c"
_LM = ["nll", "n_predicted"]
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_U = np.uint64
_MULT = np.random.default_rng(6).integers(0, 1 << 63, 8, dtype=np.uint64) * _U(2) + _U(1)


def symbols(text: str | None) -> np.ndarray:
    """Code points of the white-space normalised text, padded and closed; empty if the text has no words."""
    s = " ".join(text.split()) if text else ""
    if not s:
        return np.zeros(0, np.uint32)
    pad = chr(_BOS) * (ORDER - 1)
    body = s.replace(chr(_BOS), " ").replace(chr(_EOS), " ") if chr(_BOS) in s or chr(_EOS) in s else s
    return np.frombuffer((pad + body + chr(_EOS)).encode("utf-32-le"), np.uint32)


# -- counting ----------------------------------------------------------------------------------------

def ngram_counts(codes: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    """Distinct n-grams (of :data:`ORDER` characters) of the padded texts and their counts."""
    if not codes:
        return [], np.zeros(0, np.int64)
    c = np.concatenate(codes)
    mark = np.zeros(0x110000, bool)
    mark[c] = True
    alphabet = np.flatnonzero(mark).astype(np.uint32)
    if len(alphabet) > 4096:                                        # 12 bits a character do not do
        if len(codes) > 1:
            halves = [ngram_counts(codes[:len(codes) // 2]), ngram_counts(codes[len(codes) // 2:])]
            return halves[0][0] + halves[1][0], np.concatenate([halves[0][1], halves[1][1]])
        s = c.tobytes().decode("utf-32-le")
        count: dict[str, int] = {}
        for i in range(len(s) - ORDER + 1):
            count[s[i:i + ORDER]] = count.get(s[i:i + ORDER], 0) + 1
        return list(count), np.array(list(count.values()), np.int64)
    ids = np.zeros(0x110000, np.uint16)
    ids[alphabet] = np.arange(len(alphabet))
    i = ids[c]
    key = np.zeros(len(i) - ORDER + 1, np.uint64)
    for j in range(ORDER):
        key <<= _U(12)
        key |= i[j:len(i) - ORDER + 1 + j]
    key = key[c[ORDER - 1:] != _BOS]                                # without windows that run into the next text's padding
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    chars = np.stack([alphabet[(key[first] >> _U(12 * (ORDER - 1 - j)) & _U(4095)).astype(int)] for j in range(ORDER)], axis=1)
    s = np.ascontiguousarray(chars).astype("<u4").tobytes().decode("utf-32-le")
    return [s[k:k + ORDER] for k in range(0, len(s), ORDER)], np.diff(first, append=len(key))


def _count(batches):
    for b in batches:
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            c = symbols(text)
            if len(c):
                by_lang.setdefault(lang, []).append(c)
        for lang, codes in by_lang.items():
            for part in _pieces(codes, COUNTED):
                grams, n = ngram_counts([codes[i] for i in part])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())],
                                                 names=["lang", "gram", "c"])


def _pieces(codes: list[np.ndarray], most: int) -> Iterator[list[int]]:
    """Runs of consecutive texts (their numbers) of about ``most`` characters, texts without words left out."""
    part, size = [], 0
    for i, c in enumerate(codes):
        if len(c):
            part.append(i)
            size += len(c)
            if size >= most:
                yield part
                part, size = [], 0
    if part:
        yield part


# -- model -------------------------------------------------------------------------------------------

def kneser_ney(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (``lang`` without nulls, ``text``) -> grams (``lang``, ``gram``, ``value`` = ln p) of all orders, and contexts
    (``lang``, ``gram``, ``value`` = ln back-off weight; the empty context gives the unknown character's ln p)."""
    counts = {ORDER: materialize(map_arrow(docs.select("lang", "text"), _count, "lang string, gram string, c long")
                                 .groupBy("lang", "gram").agg(F.sum("c").alias("c")), f"lm-counts-{ORDER}")}
    tail = F.expr("substring(gram, 2)")
    for m in range(ORDER - 1, 0, -1):
        counts[m] = materialize(counts[m + 1].groupBy("lang", tail.alias("gram")).agg(F.count(F.lit(1)).alias("c")), f"lm-counts-{m}")
    grams, contexts, lower = [], [], None
    for m in range(1, ORDER + 1):
        d = _discounts(counts[m])
        ctx = F.expr(f"substring(gram, 1, {m - 1})")
        known = counts[m].join(d, "lang")                           # a written table: broadcast by its real size only
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        weight = known.groupBy("lang", ctx.alias("ctx")).agg(F.sum("c").alias("total"), F.sum(cut).alias("cut"), F.count(F.lit(1)).alias("types"))
        weight = materialize(weight, f"lm-context-{m}")
        p = known.withColumn("ctx", ctx).join(weight.withColumnRenamed("cut", "taken"), ["lang", "ctx"])
        own, gamma = (F.col("c") - cut) / F.col("total"), F.col("taken") / F.col("total")
        if m == 1:                                                  # below: uniform over the seen characters and one unknown
            p = p.select("lang", "gram", (own + gamma / (F.col("types") + 1)).alias("p"))
            off = F.col("cut") / F.col("total") / (F.col("types") + 1)
        else:
            p = p.withColumn("low", tail).join(lower, ["lang", "low"]).select("lang", "gram", (own + gamma * F.col("q")).alias("p"))
            off = F.col("cut") / F.col("total")
        p = materialize(p, f"lm-p-{m}")
        lower = p.select("lang", F.col("gram").alias("low"), F.col("p").alias("q"))
        grams.append(p.select("lang", "gram", F.log("p").alias("value")))
        contexts.append(weight.select("lang", F.col("ctx").alias("gram"), F.log(off).alias("value")))
    return _union(grams), _union(contexts)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _discounts(counts: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts, one row per language."""
    n = [F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.when(F.col("n1") + F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))

    def d(k: int):
        nk, nx = F.col(f"n{k}"), F.col(f"n{k + 1}")
        value = F.when(nk > 0, k - (k + 1) * y * nx / nk).otherwise(F.lit(k / 2))
        return F.greatest(F.lit(0.1), F.least(F.lit(k - 0.1), value)).alias(f"d{k}")

    return materialize(counts.groupBy("lang").agg(*n).select("lang", d(1), d(2), d(3)), "lm-discounts")


def _hash(columns: list[np.ndarray], lang: np.ndarray) -> np.ndarray:
    """64-bit hash of n-grams given as one array per character; ``lang`` is the language's hash."""
    h = lang.copy()
    for j, c in enumerate(reversed(columns)):
        h = h + (c.astype(np.uint64) + _U(1)) * _MULT[j]
    h ^= h >> _U(31)
    h *= _U(0x9FB21C651E98DF25)
    return h ^ (h >> _U(28))


def _lang_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang, 42)


def _slice_of(pair: np.ndarray, slices: int) -> np.ndarray:
    return (pair >> _U(17)) % _U(slices)


def store(grams: DataFrame, contexts: DataFrame, slice_entries: int = SLICE) -> tuple[DataFrame, int]:
    """The model as sorted hash arrays: rows (``slice``, ``size`` = characters, ``kind``, ``chunk`` = high byte of the hash,
    ``keys`` and ``values`` as little-endian uint64 and float64), and the number of slices (``slice`` -1: in all)."""
    both = grams.withColumn("kind", F.lit("p")).union(contexts.withColumn("kind", F.lit("b")))
    entries = both.where(F.length("gram") >= 2).count()
    slices = max(1, -(-entries // slice_entries))

    def address(batches):
        for b in batches:
            text, kinds = b.column(1).to_pylist(), b.column(3).to_pylist()
            lang = np.array([_lang_hash(x) for x in b.column(0).to_pylist()], np.uint64)
            size = np.array([len(t) for t in text])
            key, part = np.zeros(len(text), np.uint64), np.full(len(text), -1, np.int64)
            for n in range(ORDER + 1):
                at = np.flatnonzero(size == n)
                if not len(at):
                    continue
                c = np.frombuffer("".join([text[i] for i in at.tolist()]).encode("utf-32-le"), np.uint32).reshape(len(at), n)
                cols = [c[:, j] for j in range(n)]
                key[at] = _hash(cols, lang[at])
                for kind, least, last in (("p", 3, n - 1), ("b", 2, n)):     # the two characters before the predicted one
                    mine = np.array([kinds[i] == kind for i in at.tolist()])
                    if n >= least and mine.any():
                        part[at[mine]] = _slice_of(_hash([x[mine] for x in cols[last - 2:last]], lang[at][mine]), slices).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(size.astype(np.int32)), b.column(3), pa.array(key.view(np.int64)), b.column(2)],
                                             names=["slice", "size", "kind", "key", "value"])

    addressed = map_arrow(both.select("lang", "gram", "value", "kind"), address, "slice long, size int, kind string, key long, value double")
    pairs = F.sort_array(F.collect_list(F.struct("key", "value")))  # a 256th of a slice at most: bounded
    lane = F.shiftrightunsigned("key", 61).alias("lane")           # a slice is written by eight tasks at most, so in few files
    table = addressed.select("*", lane).repartition("slice", "lane").groupBy(
        "slice", "lane", "size", "kind", F.shiftrightunsigned("key", 56).alias("chunk")).agg(pairs.alias("e")).select(
        "slice", "size", "kind", "chunk", F.col("e.key").alias("keys"), F.col("e.value").alias("values"))
    return materialize_by(map_arrow(table, _as_binary, "slice long, size int, kind string, chunk long, keys binary, values binary"),
                          "lm-store", "slice"), slices


def _as_binary(batches):
    for b in batches:
        arrays = [pa.array([x.values.to_numpy().astype(kind).tobytes() for x in b.column(i)], pa.binary()) for i, kind in ((4, "<i8"), (5, "<f8"))]
        yield pa.RecordBatch.from_arrays(b.columns[:4] + arrays, names=b.schema.names)


class Part:
    """One slice opened: ``find`` looks hashes up by their high bits and a short forward scan."""

    def __init__(self, rows: list):
        self.tables: dict[tuple[int, str], list] = {}
        for r in rows:
            self.tables.setdefault((r["size"], r["kind"]), []).append((r["chunk"], np.frombuffer(r["keys"], "<u8"), np.frombuffer(r["values"], "<f8")))
        for k, v in self.tables.items():
            keys, values = (np.concatenate([x[i] for x in sorted(v, key=lambda x: x[0])]) for i in (1, 2))
            bits = max(1, min(24, int(len(keys)).bit_length()))
            begin = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << _U(64 - bits)).astype(np.int32)
            deep = int(np.diff(begin, append=len(keys)).max())
            self.tables[k] = (np.concatenate([keys, [_U(2**64 - 1)]]), np.concatenate([values, [np.nan]]), begin, _U(64 - bits), deep)

    def find(self, size: int, kind: str, key: np.ndarray) -> np.ndarray:
        """Value of each key; nan if it is not stored."""
        if (size, kind) not in self.tables:
            return np.full(len(key), np.nan)
        keys, values, begin, shift, deep = self.tables[size, kind]
        at = begin[key >> shift]
        behind = np.flatnonzero(keys[at] < key)
        for _ in range(deep):
            if not len(behind):
                break
            at[behind] += 1
            behind = behind[keys[at[behind]] < key[behind]]
        return np.where(keys[at] == key, values[at], np.nan)


def log_p(part: Part, c: np.ndarray, lang: np.ndarray, where: np.ndarray) -> np.ndarray:
    """ln p of the characters at the ends of the windows ``where`` starts (``lang``: the language hash of each): the stored value
    of the longest known n-gram plus the back-off weights of the longer known contexts."""
    cols = lambda n, at: [c[at + ORDER - n + j] for j in range(n)]  # noqa: E731  the n characters that end the window
    out = part.find(ORDER, "p", _hash(cols(ORDER, where), lang))
    open_ = np.flatnonzero(np.isnan(out))
    if len(open_):
        total = np.zeros(len(out))
        for n in range(ORDER, 0, -1):
            at, own = where[open_], lang[open_]
            if n > 1:
                ctx = [c[at + ORDER - n + j] for j in range(n - 1)]
                total[open_] += np.nan_to_num(part.find(n - 1, "b", _hash(ctx, own)))
                low = part.find(n - 1, "p", _hash(cols(n - 1, at), own))
            else:                                                    # an unknown character: what order 1 leaves to it
                low = np.nan_to_num(part.find(0, "b", _hash([], own)), nan=np.log(1 / 0x110000))
            hit = ~np.isnan(low)
            out[open_[hit]] = low[hit] + total[open_[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
    return out


# -- scoring -----------------------------------------------------------------------------------------

def base_metrics(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, lines with a word that equal an earlier line, words in repeated windows."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return (len(words), len(text) - sum(map(text.count, _SPACE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(window):
        key += h[j:n + j] * _MULT[j]
    s = np.sort(key)
    if not (s[1:] == s[:-1]).any():
        return 0
    twice = set(s[1:][s[1:] == s[:-1]].tolist())
    seen: dict[tuple, list[int]] = {}                               # equal hashes are checked word by word
    for i in np.flatnonzero(np.isin(key, np.array(list(twice), np.uint64))).tolist():
        seen.setdefault(tuple(words[i:i + window]), []).append(i)
    cover = np.zeros(len(words) + 1, np.int64)
    for at in seen.values():
        if len(at) > 1:
            np.add.at(cover, at, 1)
            np.add.at(cover, [i + window for i in at], -1)
    return int((np.cumsum(cover) > 0).sum())


_open: dict[tuple[str, int], Part] = {}


def _part(key: tuple[str, int], files: list[str]) -> Part:
    """Slice ``key`` (name of the model's pass, slice number), opened once per worker process (one at a time)."""
    if key not in _open:
        _open.clear()
        _open[key] = Part([r for f in files for r in _rows(f)])
    return _open[key]


def _rows(file: str) -> list[dict]:
    import pyarrow.parquet as pq
    with open_uri(file) as f:
        return pq.ParquetFile(f).read(["size", "kind", "chunk", "keys", "values"]).to_pylist()


def _held(batches: Iterator[pa.RecordBatch], text_at: int, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of consecutive batches with about ``most`` bytes of texts."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(text_at).nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _joined(batches: list[pa.RecordBatch], text_at: int) -> tuple[np.ndarray, np.ndarray]:
    """The padded symbols of all texts one after the other, and where each text's begin (and the last one's end)."""
    starts = np.zeros(sum(b.num_rows for b in batches) + 1, np.int64)
    c = np.empty(sum(b.column(text_at).nbytes + ORDER * b.num_rows for b in batches), np.uint32)
    for i, text in enumerate(t.as_py() for b in batches for t in b.column(text_at)):
        own = symbols(text)
        starts[i + 1] = starts[i] + len(own)
        c[starts[i]:starts[i + 1]] = own
    return c[:starts[-1]], starts


def negative_log_p(c: np.ndarray, starts: np.ndarray, seed: np.ndarray, order: list[int], open_slice, slices: int) -> np.ndarray:
    """Per text the sum of -ln p of its characters, in units of 1 / :data:`UNIT`, from the slices opened in the given order."""
    units = np.zeros(len(seed), np.int64)
    place = np.full(max(0, len(c) - ORDER + 1), slices, np.min_scalar_type(slices))   # the slice of each window; `slices`: none
    text_of = lambda where: np.searchsorted(starts, where, "right") - 1
    for at in range(0, len(place), SCORED):
        where = at + np.flatnonzero(c[at + ORDER - 1:at + ORDER - 1 + SCORED] != _BOS)
        place[where] = 0 if slices == 1 else _slice_of(_hash([c[where + ORDER - 3], c[where + ORDER - 2]], seed[text_of(where)]), slices)
    for k in order:
        part = None
        for block in range(0, len(place), COUNTED):                  # positions as 64-bit numbers for one block at a time
            mine = block + np.flatnonzero(place[block:block + COUNTED] == k)
            for at in range(0, len(mine), SCORED):
                part = part or open_slice(k)
                where = mine[at:at + SCORED]
                text = text_of(where)
                bits = np.rint(-log_p(part, c, seed[text], where) * UNIT)
                units[text[0]:text[-1] + 1] += np.bincount(text - text[0], bits).astype(np.int64)
    return units


def _score(files: list[list[str]], model: str, text_at: int, lang_at: int, held_bytes: int):
    def score(batches):
        slices = len(files)
        ways = itertools.cycle([list(range(slices)), list(range(slices - 1, -1, -1))])   # the slice that is open comes first
        for held in _held(batches, text_at, held_bytes):
            c, starts = _joined(held, text_at)
            langs = [x for b in held for x in b.column(lang_at).to_pylist()]
            of = {x: _lang_hash(x) for x in set(langs)}
            seed = np.array([of[x] for x in langs], np.uint64)
            nll = negative_log_p(c, starts, seed, next(ways), lambda k: _part((model, k), files[k]), slices) / UNIT
            n = np.maximum(np.diff(starts) - (ORDER - 1), 0)
            del c
            at = 0
            for b in held:
                m = [base_metrics(t.as_py()) for t in b.column(text_at)]
                lm = [pa.array(nll[at:at + b.num_rows]), pa.array(n[at:at + b.num_rows])]
                at += b.num_rows
                yield pa.RecordBatch.from_arrays(b.columns + [pa.array([x[j] for x in m], pa.int64()) for j in range(len(_BASE))] + lm,
                                                 names=b.schema.names + _BASE + _LM)
    return score


def perplexities(docs: DataFrame, model: DataFrame, slices: int, held: int = HELD) -> DataFrame:
    """``docs`` (``text``, ``_lm_lang``) plus the base metrics, ``nll`` and ``n_predicted``, in one pass over the rows."""
    stored = files_by(model, "slice")
    files = [stored.get("-1", []) + stored.get(str(k), []) for k in range(slices)]
    schema = StructType(docs.schema.fields + [StructField(x, LongType()) for x in _BASE]
                        + [StructField("nll", DoubleType()), StructField("n_predicted", LongType())])
    score = _score(files, uuid.uuid4().hex, docs.columns.index("text"), docs.columns.index("_lm_lang"), held)
    return map_arrow(docs, score, schema)


def judge_quality(docs: DataFrame, fence: float = FENCE, slice_entries: int = SLICE) -> DataFrame:
    """``docs`` (``text``, ``lang``) without the text, plus the base metrics, ``base_failed``, ``log_perplexity`` and ``kept``."""
    docs = own_names(docs, [*_BASE, *_LM, "base_failed", "log_perplexity", "kept", "_lm_lang", "_lm_low", "_lm_high"])
    named = docs.withColumn("_lm_lang", F.coalesce(F.concat(F.lit("l:"), F.col("lang")), F.lit("none")))
    grams, contexts = kneser_ney(named.select(F.col("_lm_lang").alias("lang"), "text"))
    model, slices = store(grams, contexts, slice_entries)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    scored = materialize(perplexities(named, model, slices).drop("text").withColumn("base_failed", failed)
                         .withColumn("log_perplexity", F.when(F.col("n_predicted") > 0, F.col("nll") / F.col("n_predicted"))), "lm-scored")
    q = scored.where("not base_failed").groupBy("_lm_lang").agg(F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000).alias("q"))
    q1, q2, q3 = (F.col("q")[i] for i in range(3))
    bands = materialize(q.select("_lm_lang", (q1 - fence * (q2 - q1)).alias("_lm_low"), (q3 + fence * (q3 - q2)).alias("_lm_high")), "lm-bands")
    inside = F.col("log_perplexity").between(F.col("_lm_low"), F.col("_lm_high"))
    return (scored.join(bands, "_lm_lang", "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
            .drop("_lm_lang", "_lm_low", "_lm_high", *_LM))
