"""Operator 10 — remove bytes covered by 50-byte strings that a smaller document has too.

Sampled window hashing in the place of full prefix doubling.  Doubling ranks every position at 1, 2, 4 ... 50 bytes; even with
unique ranks leaving, its first rounds sort a row per byte of the corpus (16 bytes of rank pair and place for each byte, some 30 times the
input on disk against a limit of 4).  Here the first rank is taken at 20 bytes and only for positions that a window chooses, and the offset
doubles once, to 50.  A position's rank at length h is the 64-bit hash ("name") of
its next h bytes, so the pair (rank at p, rank at p + h) of classical doubling needs no look-up; Spark
sorts (rank, document) rows, rows with a unique rank leave, and the others go on to the next length:

* **Round 1, length 20.**  Of each 50-byte window only the position of its smallest 20-byte hash (leftmost among equal
  ones) is ranked: equal windows choose equal positions, so nothing is lost, and only about one position in 16
  is sorted.  Positions whose rank no other document has are done.  The ranks are sorted in :data:`SLICES` passes, each over
  all texts and over its share of the ranks, so that only that share is on disk at a time.
* **Round 2, the whole run.**  The same sort carries the rank of the bytes of *all* windows that chose the position
  (50 to 80 bytes).  Where a smaller document has the same run, all of it is removed at once: this is past the
  threshold.
* **Lengths 35 and 36.**  What is left are runs that agree on 20 bytes and differ further out: ends of repeated passages, and
  bytes that agree by chance, which grow faster than the corpus.  Every window has either 15 more bytes on the left of the
  position or 16 more on its right, and 12 bits for each of these two longer strings are the low bits of the first rank.  A
  side whose bits no other document in the group has holds no equal window, so its windows leave here (bits that agree by
  chance only keep windows that the next round looks at).
* **Round 3, length 50.**  The bytes of the sides that stay are cut out of the texts, and their windows are ranked one by one at
  length 50 and sorted again, in as many passes as keep the rows of one to one for :data:`SPARSE` bytes of text.

Rows with the same rank and run inside one Arrow batch are combined before the shuffle (the smallest document stands for
all, the others are already decided), so a passage that a third of all documents share sends one row per batch.
Sorted ranks are read as a stream with a carry of one group's state, never a group at a time.  What a pass decides is
brought together by document, where spans that touch are merged, before it is written.

Nothing is removed on one 64-bit hash: round 2 compares 128 bits (24 of them those of the sides), round 3 compares 96; texts are
never cut.
Memory per task: one block of text (:data:`BLOCK`) and one batch of ranks.

Defined cases: null and empty texts have no bytes; texts under 50 bytes lose nothing and take nothing; rows with
a null id count as larger than every id and take nothing from each other; rows that share an id are one
document for the comparison and are cut each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from lakemart import session
from lakemart.llm.common import map_arrow, materialize, own_names, shuffle_cleanup

LENGTH = 50
GRAM = 20
#: Bytes of text ranked at once; longer documents are ranked in segments that overlap by one window.
BLOCK = 1 << 17
#: Ids from here on stand for rows without an id: one document for the comparison, several numbers to tell the rows apart.
_NO_ID = (1 << 63) - (1 << 40)
#: Rows that can share an id.
_SHARED = 1 << 18
_BUCKETS = 1024
#: Passes over the ranks of round 1.
SLICES = 2
#: Bytes of text for a row of round 3 in one pass, and the rows a pass may have in any case.
SPARSE, FEW = 32, 1 << 20
_WORK = ["removed", "kept", "_lm_id", "_lm_th", "_lm_spans", "_lm_probes", "_lm_key", "_lm_h1", "_lm_h2", "k", "h1", "h2", "no"]

_U = np.uint64
#: Random odd 64-bit numbers: one per byte value, and the base of the polynomial.
_BYTE = np.random.default_rng(42).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
#: A second table, for the further bits of a rank.
_BYTE2 = np.random.default_rng(43).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_AT = _U((1 << 31) - 1)
#: Packed place of a row: number among the rows of its id (18 bits), left (6), count (6), offset (33); the sign marks a decided span.
_TH, _LEFT, _COUNT, _OFF = 45, 39, 33, (1 << 33) - 1
#: Low bits of a first rank that tell the sides, and the bits of one side; the others tell the gram.
_SIDES, _SIDE = 24, 12

_tables: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        n = 2 * BLOCK + 128
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _tables.append(np.cumprod(p))
    return _tables[0], _tables[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    x *= _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class Block:
    """Segments of documents in one byte array, with the sums that give any range's hash."""

    def __init__(self, parts: list[tuple[int, int, bytes]]):
        self.doc = np.array([p[0] for p in parts], np.int64)
        self.base = np.array([p[1] for p in parts], np.int64)       # offset of the segment in its document
        data = np.frombuffer(b"".join([p[2] for p in parts]), np.uint8)
        self.ends = np.cumsum([len(p[2]) for p in parts])
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.power, self.inverse = _powers()
        self.data, self._second = data, None
        self.sums = self._sums(_BYTE)

    def _sums(self, table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(table[self.data] * self.power[:len(self.data)], out=sums[1:])
        return sums

    def second(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Ranks of the ranges by the second table."""
        if self._second is None:
            self._second = self._sums(_BYTE2)
        return (self._second[hi] - self._second[lo]) * self.inverse[lo]

    def ranks(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Raw hash of each byte range (equal ranges, equal hash; not yet mixed)."""
        return (self.sums[hi] - self.sums[lo]) * self.inverse[lo]


def blocks(texts: list[bytes], length: int = LENGTH):
    """Blocks over the texts of at least ``length`` bytes; a window lies in exactly one segment (by its start)."""
    parts, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(0, len(t) - length + 1), BLOCK):
            parts.append((i, at, t[at:at + BLOCK + length - 1]))
            size += len(parts[-1][2])
            if size >= BLOCK:
                yield Block(parts)
                parts, size = [], 0
    if parts:
        yield Block(parts)


def _in_slice(k1: np.ndarray, part: int, parts: int) -> np.ndarray:
    return (k1 >> _U(_SIDES)) % _U(parts) == _U(part)


def sampled(b: Block, length: int, gram: int, part: int = 0, parts: int = 1):
    """The chosen positions whose rank is in slice ``part``: segment, offset in the document, left (bytes from the first window
    that chose it), count (further windows), rank at ``gram`` bytes with the bits of the sides, rank of the run."""
    n, w = int(b.ends[-1]), length - gram + 1
    h = _mix((b.sums[gram:] - b.sums[:-gram]) * b.inverse[:n - gram + 1])
    low = (h & ~_AT) | np.arange(len(h), dtype=np.uint64)           # smallest hash, then leftmost
    step = 1
    while 2 * step <= w:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if w > step:
        low = np.minimum(low[:step - w], low[w - step:])
    last = np.zeros(n, np.int64)                                    # windows must not cross a segment's end
    last[b.starts] = np.diff(b.ends - length + 1, prepend=0)
    window = np.flatnonzero(np.arange(len(low)) < np.cumsum(last)[:len(low)])
    at = (low[window] & _AT).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    lo, hi = window[first], window[np.concatenate([first[1:], [len(window)]]) - 1]
    at = at[first]
    k1 = _mix(h[at])                                                # chosen hashes are small ones: mixed again
    mine = _in_slice(k1, part, parts)
    lo, hi, at, k1 = lo[mine], hi[mine], at[mine], k1[mine]
    seg = np.searchsorted(b.ends, at, "right")
    left, count = at - lo, hi - lo
    run = _mix(b.ranks(lo, hi + length) + left.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F) + count.astype(np.uint64) * _U(0x165667B19E3779F9))
    # windows that begin at least ``half`` bytes before the position have these bytes too, the others those after the gram
    half = w // 2
    before = b.ranks(np.where(left >= half, at - half, at), at + gram)
    after = b.ranks(at, np.where(left - count < half, at + length - half + 1, at + gram))
    sides = (_mix(before) >> _U(64 - _SIDE) << _U(_SIDE)) | _mix(after) >> _U(64 - _SIDE)
    return seg, at - b.starts[seg] + b.base[seg], left, count, k1 >> _U(_SIDES) << _U(_SIDES) | sides, run


def _pack(th: np.ndarray, left: np.ndarray, count: np.ndarray, off: np.ndarray) -> np.ndarray:
    return (th << _TH) | (left << _LEFT) | (count << _COUNT) | off


def _combine(k1: np.ndarray, k2: np.ndarray, ids: np.ndarray, loc: np.ndarray, length: int):
    """Map-side combine: rows to send, and the spans of rows that a smaller document of the batch decides."""
    both = _mix(k1 + _mix(k2))
    order = np.argsort(both)
    s = both[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)
    group = np.empty(len(s), np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(s)))
    doc = np.minimum(ids, _NO_ID)
    lowest = np.minimum.reduceat(doc[order], first) if len(s) else doc
    send = doc == lowest[group]
    return send, _merged_spans(ids[~send], loc[~send], length)


def _merged_spans(ids: np.ndarray, loc: np.ndarray, length: int):
    """(ids, text hash, start, bytes) of the runs of packed places, touching ones merged."""
    lo = (loc & _OFF) - (loc >> _LEFT & 63)
    return _merged(ids, loc >> _TH, lo, lo + (loc >> _COUNT & 63) + length)


def _merged(ids: np.ndarray, th: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(ids, text hash, start, bytes), touching ranges of a row merged."""
    if not len(ids):
        return ids, th, lo, hi - lo
    order = np.lexsort((lo, th, ids))
    ids, th, lo, hi = ids[order], th[order], lo[order], hi[order]
    doc = np.concatenate([[True], (ids[1:] != ids[:-1]) | (th[1:] != th[:-1])])
    # running end within a document: places of a later document are lifted above all of an earlier one
    lift = np.cumsum(doc) * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(hi + lift)
    new = np.concatenate([[True], lo[1:] + lift[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    ends = reach[np.concatenate([at[1:], [len(ids)]]) - 1] - lift[at]
    return ids[at], th[at], lo[at], ends - lo[at]


_RANKED = "k1 long, k2 long, id long, loc long"
_DECIDED = "id long, th int, lo long, n int"
_GATHERED = "id long, th int, spans binary, probes binary"
_PIECES = "id long, th int, lo long, piece binary"


def _ranked_batch(k1, k2, ids, loc, spans) -> pa.RecordBatch:
    """Rows to sort, and decided spans riding along on a scattered key (sign of ``loc``; ``k2`` = bytes)."""
    si, st, sl, sn = spans
    k1 = np.concatenate([k1.view(np.int64), _mix(si.view(np.uint64) + sl.view(np.uint64)).view(np.int64)])
    k2 = np.concatenate([k2.view(np.int64), sn])
    loc = np.concatenate([loc, (st << _TH | sl) | np.int64(-1 << 63)])
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (k1, k2, np.concatenate([ids, si]), loc)], names=["k1", "k2", "id", "loc"])


def _texts(column) -> list[bytes]:
    return [t.encode() if t else b"" for t in column.to_pylist()]


def _rank_runs(length: int, gram: int, part: int, parts: int):
    def rank(batches):
        for b in batches:
            ids, th = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            out = []
            for block in blocks(_texts(b.column(2)), length):
                seg, off, left, count, k1, k2 = sampled(block, length, gram, part, parts)
                doc = block.doc[seg]
                out.append((k1, k2, ids[doc], _pack(th[doc], left, count, off)))
            if out:
                k1, k2, i, loc = (np.concatenate(x) for x in zip(*out))
                send, spans = _combine(k1, k2, i, loc, length)
                yield _ranked_batch(k1[send], k2[send], i[send], loc[send], spans)
    return rank


def _pieces(length: int):
    """The bytes that the windows of probes cover, a row for each run of windows without a gap."""
    def cut(batches):
        for b in batches:
            ids, th = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
            texts, probes = _texts(b.column(2)), [b"".join(p) for p in b.column(3).to_pylist()]
            place = np.frombuffer(b"".join(probes), np.int64)
            row = np.repeat(np.arange(len(probes)), np.array([len(p) // 8 for p in probes], np.int64))
            lo = (place & _OFF) - (place >> _LEFT & 63)
            row, _, lo, n = _merged(row, np.zeros(len(row), np.int64), lo, lo + (place >> _COUNT & 63) + 1)
            pieces = [texts[r][start:end] for r, start, end in zip(row.tolist(), lo.tolist(), (lo + n + length - 1).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(th[row]), pa.array(lo), pa.array(pieces, pa.binary())],
                                             names=["id", "th", "lo", "piece"])
    return cut


def _rank_windows(length: int, part: int, parts: int):
    def rank(batches):
        for b in batches:
            ids, th, lo = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64), b.column(2).to_numpy()
            out = []
            for block in blocks(b.column(3).to_pylist(), length):
                n = block.ends - block.starts - length + 1
                seg, nth = np.repeat(np.arange(len(n)), n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                at = block.starts[seg] + nth
                k1 = _mix(block.ranks(at, at + length))
                mine = _in_slice(k1, part, parts)
                k1, at, seg, nth = k1[mine], at[mine], seg[mine], nth[mine]
                doc = block.doc[seg]
                out.append((k1, _mix(block.second(at, at + length)) >> _U(32), ids[doc], th[doc] << _TH | lo[doc] + block.base[seg] + nth))
            if out:
                k1, k2, i, loc = (np.concatenate(x) for x in zip(*out))
                send, spans = _combine(k1, k2, i, loc, length)
                yield _ranked_batch(k1[send], k2[send], i[send], loc[send], spans)
    return rank


def _with_another(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a row's key also comes with another document."""
    out = np.zeros(len(key), bool)
    if len(key):
        order = np.argsort(key)
        s, d = key[order], doc[order]
        at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        out[order] = np.repeat(np.minimum.reduceat(d, at) < np.maximum.reduceat(d, at), np.diff(at, append=len(s)))
    return out


def _probes(k1: np.ndarray, doc: np.ndarray, loc: np.ndarray, group: np.ndarray, closed: np.ndarray, half: int):
    """Of the smallest documents' places in groups of several runs, those to look at again, each cut down to the windows of
    the sides that another document may share; in a group that is not ``closed`` here, any may."""
    left, count = loc >> _LEFT & 63, loc >> _COUNT & 63
    sides = []
    for has, bits in ((left >= half, k1 >> _SIDE), (left - count < half, k1)):
        may, i = has & ~closed, np.flatnonzero(has & closed)
        may[i] = _with_another(group[i] << _SIDE | bits[i] & ((1 << _SIDE) - 1), doc[i])
        sides.append(may)
    before, after = sides
    last = left - count                                             # bytes from the last window
    left, last = np.where(before, left, np.minimum(left, half - 1)), np.where(after, last, np.maximum(last, half))
    cut = loc & ~((np.int64(63) << _LEFT) | (np.int64(63) << _COUNT)) | (left << _LEFT) | ((left - last) << _COUNT)
    return before | after, cut


def _decide(length: int, gram: int | None = None):
    """Stream over rows sorted by (k1, k2, id): a row whose (k1, k2) a smaller id has is a removed span.  With ``gram``, k1 ranks
    grams and tells the sides, and the rows of the smallest id become probes (``n`` = -1) if their gram also comes with
    another run that may have an equal window."""
    def out(ids, loc, spans: bool):
        th = (loc >> _TH & ((1 << 18) - 1)).astype(np.int32)
        if not spans:
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(th), pa.array(loc), pa.array(np.full(len(ids), -1, np.int32))],
                                              names=["id", "th", "lo", "n"])
        i, t, lo, n = _merged_spans(ids, loc, length)
        return pa.RecordBatch.from_arrays([pa.array(i), pa.array(t.astype(np.int32)), pa.array(lo), pa.array(n.astype(np.int32))],
                                          names=["id", "th", "lo", "n"])

    def decide(batches):
        none = np.zeros(0, np.int64)
        carry, carried_multi, dummy = (none, none, none, none), False, False
        for b in batches:
            k1, k2, ids, loc = (b.column(i).to_numpy() for i in range(4))
            decided = loc < 0
            if decided.any():
                d = loc[decided]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[decided]), pa.array((d >> _TH & ((1 << 18) - 1)).astype(np.int32)), pa.array(d & _OFF),
                     pa.array(k2[decided].astype(np.int32))], names=["id", "th", "lo", "n"])
                k1, k2, ids, loc = (x[~decided] for x in (k1, k2, ids, loc))
            if not len(k1):
                continue
            kept = len(carry[0])
            k1, k2, ids, loc = (np.concatenate([c, x]) for c, x in zip(carry, (k1, k2, ids, loc)))
            grams = k1 >> _SIDES if gram else k1
            new1 = np.concatenate([[True], grams[1:] != grams[:-1]])
            new2 = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
            at1, at2 = np.flatnonzero(new1), np.flatnonzero(new2)
            of1, of2 = np.cumsum(new1) - 1, np.cumsum(new2) - 1
            doc = np.minimum(ids, _NO_ID)
            smallest = doc[at2][of2] == doc
            multi = np.bincount(of1[at2]) > 1
            closed = np.ones(len(at1), bool)                        # groups that begin and end in this batch
            closed[-1] = False
            if kept:
                closed[0] = False
                multi[0] |= carried_multi
            fresh = np.ones(len(k1), bool)
            fresh[:kept] = not dummy                                # a dummy only carries state
            span = ~smallest & fresh
            if span.any():
                yield out(ids[span], loc[span], True)
            if gram:
                i = np.flatnonzero(smallest & fresh & multi[of1])
                probe, places = _probes(k1[i], doc[i], loc[i], of1[i], closed[of1[i]], (length - gram + 1) // 2)
                if probe.any():
                    yield out(ids[i[probe]], places[probe], False)
            tail = np.arange(len(k1)) >= at1[-1]
            carried_multi = bool(multi[-1])
            if carried_multi or not gram:                           # already sent: keep the last group's key and smallest id
                i = at2[-1]
                carry, dummy = (k1[i:i + 1], k2[i:i + 1], ids[i:i + 1], loc[i:i + 1]), True
            else:                                                   # one run so far: its smallest document's places wait
                wait = tail & smallest
                carry, dummy = (k1[wait], k2[wait], ids[wait], loc[wait]), False
    return decide


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The bytes of ``counts`` values each."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * (values.nbytes // max(1, len(values)))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _gather(batches):
    """Decided rows sorted by (id, th) to a row for each of these and batch: its merged spans (pairs of start and bytes)
    and its probes."""
    for b in batches:
        ids, th, lo, n = (b.column(i).to_numpy() for i in range(4))
        if not len(ids):
            continue
        new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (th[1:] != th[:-1])])
        at, row, probe = np.flatnonzero(new), np.cumsum(new) - 1, n < 0
        of, _, start, size = _merged(row[~probe], np.zeros(int((~probe).sum()), np.int64), lo[~probe], lo[~probe] + n[~probe])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[at]), pa.array(th[at]), _binary(np.stack([start, size], 1).astype(np.uint32), np.bincount(of, minlength=len(at))),
             _binary(lo[probe], np.bincount(row[probe], minlength=len(at)))], names=["id", "th", "spans", "probes"])


def _spans(pieces: list[bytes] | None) -> list[list[int]]:
    """[start, bytes] of what :func:`_gather` wrote."""
    return np.frombuffer(b"".join(pieces or ()), np.uint32).reshape(-1, 2).tolist()


def _pass(ranked: DataFrame, decide, name: str) -> DataFrame:
    """Sorts ranks, decides and brings what is decided together by document."""
    decided = map_arrow(ranked.repartition(F.shiftright("k1", _SIDES)).sortWithinPartitions("k1", "k2", "id"), decide, _DECIDED)
    return materialize(map_arrow(decided.repartition("id", "th").sortWithinPartitions("id", "th"), _gather, _GATHERED), name)


def _gathered(rows: DataFrame, what: str) -> DataFrame:
    """``id``, ``th`` and all pieces of ``what``."""
    return rows.where(F.octet_length(what) > 0).groupBy("id", "th").agg(F.collect_list(what).alias(what))


def repeat_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Removed spans of ``docs`` (``id``, ``th``, ``text``): ``id``, ``th``, ``spans`` (for :func:`_spans`); they may overlap."""
    if not 1 <= length - gram + 1 <= 64:
        raise ValueError("the gram must be at most 63 bytes shorter than the length")
    with shuffle_cleanup(docs.sparkSession):
        found = [_pass(map_arrow(docs, _rank_runs(length, gram, i, SLICES), _RANKED), _decide(length, gram), f"repeat-runs-{i}")
                 for i in range(SLICES)]
        first = reduce(DataFrame.union, found)
        if not first.where(F.octet_length("probes") > 0).isEmpty():
            asked = docs.join(_gathered(first, "probes"), ["id", "th"]).select("id", "th", "text", "probes")
            with session.Scratch(docs.sparkSession) as passes:       # the pieces go after the last pass
                pieces = session.materialize(map_arrow(asked, _pieces(length), _PIECES), "repeat-pieces", passes)
                windows = pieces.agg(F.sum(F.octet_length("piece") - (length - 1))).first()[0]
                parts = 1 if windows <= FEW else -(-windows // max(docs.agg(F.sum(F.octet_length("text"))).first()[0] // SPARSE, FEW))
                found += [_pass(map_arrow(pieces, _rank_windows(length, i, parts), _RANKED), _decide(length), f"repeat-windows-{i}")
                          for i in range(parts)]
    return _gathered(reduce(DataFrame.union, found), "spans")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``_lm_id`` and ``_lm_th``, which together name a row's id and text.

    Only rows without an id and rows that share one need a number, by the 128-bit hash of their text; they are found and
    numbered without the texts, and joined back by (id, hash): where there are none, or few, no text moves."""
    ids = docs.select(F.col("doc_id").cast("long").alias("_lm_key"))
    shared = materialize(ids.groupBy("_lm_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or _lm_key is null"), "repeat-shared")
    if shared.isEmpty():                                             # every row has an id of its own: that names it
        return docs.withColumns({"_lm_id": F.col("doc_id").cast("long"), "_lm_th": F.lit(0)})
    hashed = docs.withColumns({"_lm_key": F.col("doc_id").cast("long"), "_lm_h1": F.xxhash64("text"), "_lm_h2": F.xxhash64(F.lit(1), "text")})
    keys = hashed.select("_lm_key", "_lm_h1", "_lm_h2")
    most = shared.where("_lm_key is not null").agg(F.max("n")).first()[0] or 0
    if most > _SHARED:
        raise ValueError(f"{most} rows share an id; at most {_SHARED} can")
    # hashes cut the rows of an id (all rows without one, say) into buckets, which are counted before they are numbered
    rows = keys.join(shared.select(F.col("_lm_key").alias("k")), F.col("_lm_key").eqNullSafe(F.col("k")), "left_semi").distinct()
    rows = materialize(rows.withColumn("b", F.pmod("_lm_h1", F.lit(_BUCKETS)).cast("int")), "repeat-shared-rows")
    sizes = rows.groupBy("_lm_key", "b").agg(F.count(F.lit(1)).alias("c"))
    before = sizes.withColumn("at", F.sum("c").over(Window.partitionBy("_lm_key").orderBy("b")) - F.col("c")).select(
        F.col("_lm_key").alias("k"), F.col("b").alias("kb"), "at")
    place = F.row_number().over(Window.partitionBy("_lm_key", "b").orderBy("_lm_h1", "_lm_h2")) - 1
    numbered = materialize(rows.withColumn("place", place).join(before, F.col("_lm_key").eqNullSafe(F.col("k")) & (F.col("b") == F.col("kb")))
                           .select(F.col("_lm_key").alias("k"), F.col("_lm_h1").alias("h1"), F.col("_lm_h2").alias("h2"),
                                   (F.col("at") + F.col("place")).alias("no")), "repeat-numbers")
    same = F.col("_lm_key").eqNullSafe(F.col("k")) & (F.col("_lm_h1") == F.col("h1")) & (F.col("_lm_h2") == F.col("h2"))
    no = F.coalesce(F.col("no").cast("long"), F.lit(0).cast("long"))
    joined = hashed.join(numbered, same, "left")
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns),
                         F.coalesce(F.col("_lm_key"), F.lit(_NO_ID) + F.shiftright(no, 18)).alias("_lm_id"),
                         (no % _SHARED).cast("int").alias("_lm_th"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) plus ``removed`` (byte ranges, end exclusive) and ``kept`` (the remaining bytes).

    ``doc_id`` is an integer below 2**63 - 2**40."""
    docs = own_names(docs, _WORK)
    keyed = _numbered(docs)
    spans = repeat_spans(keyed.select(F.col("_lm_id").alias("id"), F.col("_lm_th").alias("th"), "text"), length, gram)
    per_doc = spans.select(F.col("id").alias("_lm_id"), F.col("th").alias("_lm_th"), F.col("spans").alias("_lm_spans"))
    joined = keyed.join(per_doc, ["_lm_id", "_lm_th"], "left").select(*docs.columns, "_lm_spans")
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType(docs.schema.fields + [StructField("removed", ArrayType(span)), StructField("kept", BinaryType())])
    return map_arrow(joined, _cut(docs.columns.index("text")), schema)


def _cut(at: int):
    def cut(batches):
        for b in batches:
            removed, kept = [], []
            for text, spans in zip(_texts(b.column(at)), b.column(b.num_columns - 1).to_pylist()):
                runs: list[list[int]] = []
                for lo, hi in sorted((lo, lo + n) for lo, n in _spans(spans)):
                    if runs and lo <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], hi)
                    else:
                        runs.append([lo, hi])
                removed.append([{"start": lo, "end": hi} for lo, hi in runs])
                edges = [0] + [x for r in runs for x in r] + [len(text)]
                kept.append(b"".join([text[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)]))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(b.columns[:-1] + [pa.array(removed, kind), pa.array(kept, pa.binary())],
                                             names=b.schema.names[:-1] + ["removed", "kept"])
    return cut
