"""Operator 1 — token-id files under Re-Pair grammar compression.

Documents are range-partitioned by id and sorted; each partition is written as a run of
shards of about :data:`SHARD_TOKENS` tokens.  A shard is one row of a Parquet dataset (so
Spark's commit protocol makes it safe against lost executors and repeated tasks) and holds one
self-contained binary payload:

====================  =====================================================================
part                  content (little-endian)
====================  =====================================================================
header                magic ``RPG1``, number of documents, base (first nonterminal id), number of rules, symbol width
document symbols      per document: number of symbols of the compressed sequence (uint32)
document tokens       per document: number of tokens (uint32)
rules                 per rule: left and right symbol (uint32); rule ``r`` is nonterminal ``base + r``
expansion lengths     per rule: number of tokens it stands for (uint32)
sequence              the compressed symbols (uint16 if all fit, else uint32)
====================  =====================================================================

Re-Pair per shard: the pairs of neighbouring symbols are counted exactly; all pairs whose count
is within :data:`BAND` of the most frequent one (and at least :data:`MIN_COUNT`) become
nonterminals and are replaced, and so on with new counts until no pair is frequent (counting only places whose pair may
have become the next to be replaced); symbols become 32 bits wide when 16 bits have no
room for a rule.  Overlapping occurrences are resolved from the left.  Pairs never cross a document.  So every document is a symbol range
of its own and the expansion lengths give the place of any token without decoding what is before
(:func:`decode_range`).

Defined cases: null and empty texts have the end id only; null ids come first; rows with equal id are ordered by
text, and repeated rows follow each other; a text of any length stays in one shard; an empty table
writes no shard.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lakemart.llm.common import map_arrow, materialize, shuffle_cleanup

END_ID = 1
SHARD_TOKENS = 1 << 20
#: A pair is replaced in a round if its count is at least the top count divided by this.
BAND = 8
#: A rule takes 12 bytes and saves 2 at each place, so a pair seen 6 times or less gains nothing.
MIN_COUNT = 8
#: Words and pieces of words a worker keeps encoded before it starts anew.
CACHE_WORDS = 2_000_000
#: Signs that end a word often and are one piece together (no apostrophe, which may begin a contraction).
_TAIL = b"!\"#$%&()*+,-./:;=>?@[\\]^_`{}~"
#: Words, contractions, digits, signs, accents and white space in all their neighbourhoods.
_SAMPLE = ("It's The END. don't  stop!! a1b22 3.14 x,y;z (see [1]) $5.00 50% \t été ÜBER naïve señor, ¿qué? «oui» e-mail a_b "
           "\n\n tab\there we'll they've I'm he'd 'quoted' '' \u201cquote\u201d \u2014 word\u2014word \u4f60\u597d caf\u0065\u0301 end\u00a0space ...")
_MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sIIIHxx")


# -- encoding ---------------------------------------------------------------------------------------

class WordEncoder(dict):
    """Token ids (as little-endian uint32 bytes) of white-space separated words, encoded on first use.

    Valid for tokenizers whose pre-tokenizer drops white space and never joins across it: those with the steps named in
    ``by_word`` for which :meth:`check` finds both ways equal; otherwise whole texts are encoded.  Words of plain Latin letters skip the
    normaliser: they are lower-cased and cut by the tokenizer's own pattern, and its model encodes the pieces.  Pieces are kept among
    the words: the pattern cuts a piece that stands alone as itself.
    """

    _PLAIN = re.compile("[!-~¡-¬®-įĲ-ňŊ-ž]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = [t["type"] for t in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = names == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"] \
            and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
        self.specials = tuple(t["content"] for t in spec.get("added_tokens", []))
        if self.by_word:
            self.cut = regex.compile(cuts[0]["pattern"]["Regex"])
        self.as_bytes = _byte_letters()
        self.cut_piece = self.tokenizer.model.tokenize
        self.by_word = self.by_word and self.check()

    def check(self) -> bool:
        """Whether words encoded one by one and white space between them make up :data:`_SAMPLE` as a whole."""
        words = b"".join(map(self.__getitem__, _SAMPLE.encode().split()))
        self.clear()
        return words == self.whole(_SAMPLE)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        head = word.rstrip(_TAIL)
        low = head.lower()
        if not low.isalpha():                          # bytes: ASCII letters only
            text = head.decode()
            low = text.lower().encode() if text.isalpha() and self._PLAIN.fullmatch(text) else None
        if low is not None:                            # letters, then signs: two pieces of the pattern at most
            if low == word:
                return self._piece(word)
            ids = self.get(low) or self._piece(low)
            if len(head) < len(word):
                tail = word[len(head):]
                ids += self.get(tail) or self._piece(tail)
        else:
            text = word.decode()
            if self._PLAIN.fullmatch(text) and not any(s in text for s in self.specials):
                ids = b"".join([self.get(p) or self._piece(p) for p in map(str.encode, self.cut.findall(text.lower()))])
            else:
                ids = self.whole(text)
        self[word] = ids
        return ids

    def _piece(self, piece: bytes) -> bytes:
        letters = piece.decode() if piece.isascii() else "".join([self.as_bytes[b] for b in piece])
        ids = array("I", [t.id for t in self.cut_piece(letters)])
        if sys.byteorder == "big":
            ids.byteswap()
        self[piece] = ids = ids.tobytes()
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | bytes | None) -> bytes:
        """Of a text or its UTF-8 bytes."""
        if not text:
            return b""
        if not self.by_word:
            return self.whole(text if isinstance(text, str) else text.decode())
        return b"".join(map(self.__getitem__, (text.encode() if isinstance(text, str) else text).split()))


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if it is a visible
    Latin-1 character, else the next code point from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


# -- grammar ----------------------------------------------------------------------------------------

def compress(tokens: np.ndarray, lengths: np.ndarray) -> bytes:
    """One shard: the tokens of consecutive documents with the given lengths (all at least 1)."""
    base = int(tokens.max(initial=0)) + 1
    room = (1 << 31) - base                                          # nonterminals that 32-bit symbols have room for
    seq = tokens.astype(np.uint32)
    # of the pair that begins at a place: its count's bits when last counted, _NEW if not counted yet, 0 if a document ends there.
    # Symbols that a round leaves are paired as often as before or less, so the places of a rarer pair are counted again only
    # when the bound has come down to it, or when a replacement beside them makes it another pair
    level = np.full(len(seq), _NEW, np.uint8)
    level[np.cumsum(lengths) - 1] = 0
    rules: list[np.ndarray] = []
    size = np.ones(base, np.uint32)                                  # tokens that each symbol stands for
    n_rules, cut = 0, MIN_COUNT.bit_length()
    while n_rules < room:
        while True:
            codes, counts, places = _count(seq, np.flatnonzero(level >= cut), base + n_rules <= 1 << 16)
            bound = max(MIN_COUNT, -(-int(counts.max(initial=0)) // BAND))
            if bound.bit_length() >= cut:                            # pairs not counted are below it
                break
            cut = bound.bit_length()
        frequent = np.flatnonzero(counts >= bound)
        if not len(frequent):
            break
        if len(frequent) > room - n_rules:
            frequent = np.sort(frequent[np.argsort(-counts[frequent], kind="stable")[:room - n_rules]])
        level[places] = np.repeat(np.frexp(counts)[1].astype(np.uint8), counts)
        symbol = np.zeros(len(codes), np.uint64)                     # that a pair becomes; 0: none
        symbol[frequent] = base + n_rules + np.arange(len(frequent))
        symbol = np.repeat(symbol, counts)
        hit = np.flatnonzero(symbol)
        hit = np.sort(places[hit].view(np.uint64) << _HALF | symbol[hit])
        where = (hit >> _HALF).view(np.int64)
        # of overlapping occurrences (a run of neighbouring hits) every second one is taken, from the left
        run_start = np.maximum.accumulate(np.where(np.diff(where, prepend=-2) > 1, where, 0))
        even = (where - run_start) & 1 == 0
        where = where[even]
        seq[where] = hit[even].astype(np.uint32)                     # the lower half
        level[where] = np.where(level[where + 1], _NEW, 0)
        level[where - 1] = np.where(level[where - 1], _NEW, 0)       # before place 0 comes the end, where a document ends
        stays = np.ones(len(seq), bool)
        stays[where + 1] = False
        seq, level = seq[stays], level[stays]
        chosen = codes[frequent]
        rules.append(np.stack([chosen >> _HALF, chosen & _LOW], axis=1).astype(np.uint32))
        size = np.concatenate([size, size[rules[-1]].sum(axis=1, dtype=np.uint32)])
        n_rules += len(chosen)
        cut = max(MIN_COUNT.bit_length(), bound.bit_length() - 1)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    width = 2 if base + n_rules <= 1 << 16 else 4
    symbols = np.diff(np.flatnonzero(level == 0), prepend=-1).astype("<u4")
    return b"".join([_HEAD.pack(_MAGIC, len(lengths), base, n_rules, width), symbols.tobytes(), lengths.astype("<u4").tobytes(),
                     table.astype("<u4").tobytes(), size[base:].astype("<u4").tobytes(), seq.astype(f"<u{width}").tobytes()])


_NEW = 255
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def _count(seq: np.ndarray, at: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that begin at the places ``at``: their codes (left symbol, then 32 bits of the right one) in ascending order, their counts,
    and the places, pair by pair."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, int), at
    if small and len(seq) <= 1 << 32:                                # all symbols have 16 bits: pair and place are sorted as one number
        s = (seq[at] << np.uint32(16) | seq[1:][at]).astype(np.uint64)
        s <<= _HALF
        s |= at.view(np.uint64)
        s.sort()
        first = np.concatenate([[0], np.flatnonzero((s[1:] ^ s[:-1]) > _LOW) + 1])
        codes, places = s[first] >> _HALF, (s & _LOW).view(np.int64)
        codes = codes >> np.uint64(16) << _HALF | codes & np.uint64(0xFFFF)
    else:
        pairs = seq[at].astype(np.uint64) << _HALF | seq[1:][at]
        order = np.argsort(pairs)
        places, s = at[order], pairs[order]
        first = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1])
        codes = s[first]
    return codes, np.diff(first, append=len(at)), places


class Shard:
    """A payload opened for reading."""

    def __init__(self, payload: bytes):
        magic, docs, self.base, n_rules, width = _HEAD.unpack_from(payload)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.symbols, self.lengths = take("<u4", docs), take("<u4", docs)
        self.rules, self.sizes = take("<u4", 2 * n_rules).reshape(-1, 2), take("<u4", n_rules)
        self.sequence = take(f"<u{width}", int(self.symbols.sum(dtype=np.int64)))
        self.starts = np.concatenate([[0], np.cumsum(self.symbols, dtype=np.int64)])

    def _pool(self) -> tuple[np.ndarray, np.ndarray]:
        """All rule expansions one after the other, and where each begins."""
        pool = np.arange(self.base, self.base + len(self.rules), dtype=np.int64)
        while len(at := np.flatnonzero(pool >= self.base)):          # each nonterminal gives way to its two symbols
            pair = self.rules[pool[at] - self.base]
            twice = np.ones(len(pool), np.int64)
            twice[at] = 2
            pool = np.repeat(pool, twice)
            at += np.arange(len(at))
            pool[at], pool[at + 1] = pair[:, 0], pair[:, 1]
        return pool.astype(np.uint32), np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])

    def _size_of(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        big = symbols >= self.base
        out[big] = self.sizes[symbols[big].astype(np.int64) - self.base]
        return out

    def tokens(self) -> np.ndarray:
        """The tokens of the whole shard."""
        if not len(self.rules):
            return self.sequence.astype(np.uint32)
        pool, begin = self._pool()                                    # after all plain symbols, which stand for themselves
        pool = np.concatenate([np.arange(self.base, dtype=np.uint32), pool])
        begin = np.concatenate([np.arange(self.base), self.base + begin[:-1]])
        size = np.concatenate([np.ones(self.base, np.int64), self.sizes])[self.sequence]
        at = np.cumsum(size)
        n = int(at[-1])
        shift = begin[self.sequence] - (at - size)                    # from a token's place to its place in the pool
        return pool[np.repeat(shift, size) + np.arange(n)]

    def decode_range(self, doc: int, lo: int, hi: int) -> list[int]:
        """Tokens ``lo`` to ``hi`` of a document, expanding only the symbols that cover them."""
        seq = self.sequence[self.starts[doc]:self.starts[doc + 1]]
        ends = np.cumsum(self._size_of(seq))
        hi = min(hi, int(ends[-1]))
        if lo >= hi:
            return []
        i, j = int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(ends, hi, "left"))
        before = int(ends[i - 1]) if i else 0
        out: list[int] = []
        stack = seq[i:j + 1][::-1].astype(int).tolist()
        while stack:
            s = stack.pop()
            if s < self.base:
                out.append(s)
            else:
                stack += (int(self.rules[s - self.base][1]), int(self.rules[s - self.base][0]))
        return out[lo - before:hi - before]


# -- files ------------------------------------------------------------------------------------------

def write_shards(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the token file of ``docs`` (``doc_id``, ``text``) and return it as read back: one row per shard with
    ``part``, ``seq`` (order inside the part), ``doc_ids``, ``n_tokens`` and ``payload``."""
    order = [F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")]    # range bounds are sampled from ids only, not from texts
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranged = docs.select("doc_id", "text").repartitionByRange(order[0]).sortWithinPartitions(*order)
    schema = f"part int, seq int, doc_ids array<{kind}>, n_tokens long, payload binary"
    shards = map_arrow(ranged, _write(tokenizer, end_id, shard_tokens), schema)
    with shuffle_cleanup(docs.sparkSession):
        if path is None:
            return materialize(shards, "token-shards")
        shards.write.parquet(path)
    return docs.sparkSession.read.schema(shards.schema).parquet(path)


def _write(tokenizer: str, end_id: int, shard_tokens: int):
    def write(batches):
        part, seq = TaskContext.get().partitionId(), 0
        encoder = _encoder(tokenizer)
        end = struct.pack("<I", end_id)
        ids, coded, size, kind = [], [], 0, pa.int64()

        def flush():
            tokens = np.frombuffer(b"".join(coded), "<u4")
            lengths = np.array([len(c) // 4 for c in coded], np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([ids], pa.list_(kind)),
                 pa.array([len(tokens)], pa.int64()), pa.array([compress(tokens, lengths)], pa.binary())],
                names=["part", "seq", "doc_ids", "n_tokens", "payload"])

        for b in batches:
            kind = b.column(0).type
            for i, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                ids.append(i)
                coded.append(encoder.encode(text) + end)
                size += len(coded[-1]) // 4
                if size >= shard_tokens:
                    yield flush()
                    ids, coded, size, seq = [], [], 0, seq + 1
        if ids:
            yield flush()
    return write


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document of a token file: ``doc_id``, ``start`` (tokens of all documents before it), ``n_tokens``, ``ids_crc32``
    (of all its ids as little-endian uint32)."""
    # starts: totals per part (one row per range partition), then inside the part
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part_start = totals.select("part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (shards.select("part", "seq", "n_tokens").join(part_start, "part")
              .select("part", "seq", (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("shard_start")))
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    docs = map_arrow(shards.select("part", "seq", "doc_ids", "payload"), _read,
                     f"part int, seq int, doc_id {kind}, at long, n_tokens long, ids_crc32 long")
    return (docs.join(materialize(starts, "token-starts"), ["part", "seq"])
            .select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def _read(batches):
    for b in batches:
        for part, seq, ids, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
            shard = Shard(payload)
            raw = shard.tokens().astype("<u4").tobytes()
            ends = np.cumsum(shard.lengths, dtype=np.int64)
            starts = ends - shard.lengths
            crcs = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
            n = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), ids.values, pa.array(starts, pa.int64()),
                 pa.array(shard.lengths.astype(np.int64)), pa.array(crcs, pa.int64())],
                names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])
