import zlib
from collections import Counter

import numpy as np
import pytest

from helpers import documents, empty
from lakemart.llm import repair
from lakemart.llm.queries import tokenizer_path

ODD = ["", " ", "ΣΑΣ Ὀδυσσεύς İstanbul café́ x y <|endoftext|>a <|start 's don't 12a3 ß ŉ ſ ĳ ﬁ 漢字 \x1c\x85z",
       "a<|endoftext|> b", "I'LL WE'VE\tx\x0by\x0cz\r\nq", "😀 a\u200db ÀÉ ñandú", "word, word. WORD; (x) #tag 3.14"]


@pytest.fixture(scope="module")
def encoder():
    return repair.WordEncoder(tokenizer_path())


def test_word_encoder_equals_the_tokenizer(encoder):
    assert encoder.by_word
    for t in ODD * 2:                                   # the second time from the cache
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("alphabet", [3, 40, 60_000, 200_000])
def test_grammar_round_trip_and_random_access(alphabet):
    g = np.random.default_rng(alphabet)
    phrase = g.integers(0, alphabet, 50)
    lengths = g.integers(1, 400, 60)
    tokens = np.concatenate([g.integers(0, alphabet, n) if g.random() < 0.3 else np.resize(phrase, n) for n in lengths]).astype(np.uint32)
    shard = repair.Shard(repair.compress(tokens, lengths.astype(np.uint32)))
    assert (shard.tokens() == tokens).all() and len(shard.sequence) < len(tokens)
    ends = np.cumsum(lengths)
    for _ in range(200):
        d = int(g.integers(len(lengths)))
        lo, hi = sorted(g.integers(0, lengths[d] + 2, 2).tolist())
        assert shard.decode_range(d, lo, hi) == tokens[ends[d] - lengths[d]:ends[d]][lo:hi].tolist()
    for r, (a, b) in enumerate(shard.rules.tolist()):   # a rule refers to earlier symbols only
        assert max(a, b) < shard.base + r


@pytest.mark.parametrize("phrases", [200, 20_000])
def test_grammar_goes_on_until_no_pair_is_frequent(phrases):
    """Pairs seen 16 to 23 times become rules, also those that 16-bit ids have no room for."""
    g = np.random.default_rng(phrases)
    pairs = np.stack([g.permutation(49_000)[:phrases], g.permutation(49_000)[:phrases]], axis=1)
    tokens = pairs[g.permutation(np.repeat(np.arange(phrases), 18))].reshape(-1).astype(np.uint32)
    lengths = np.full(len(tokens) // 40, 40, np.uint32)
    shard = repair.Shard(repair.compress(tokens, lengths))
    assert (shard.tokens() == tokens).all() and len(shard.rules) >= phrases
    inner = np.ones(len(shard.sequence), bool)
    inner[shard.starts[1:] - 1] = False
    s = shard.sequence.astype(np.int64)
    assert np.unique((s[:-1] << 32 | s[1:])[inner[:-1]], return_counts=True)[1].max(initial=0) < 16


def _plain_rules(docs, band, least):
    """The rules of :func:`repair.compress` with every pair of every round counted."""
    top_id, rules = max(map(max, docs)) + 1, []
    counted = 0
    while True:
        seen = Counter(p for d in docs for p in zip(d, d[1:]))
        counted += sum(seen.values())
        top = max(seen.values(), default=0)
        chosen = sorted(p for p, c in seen.items() if c >= max(least, -(-top // band)))
        if not chosen:
            return rules, docs, counted
        new = {p: top_id + len(rules) + i for i, p in enumerate(chosen)}
        rules += chosen
        for k, d in enumerate(docs):
            out, i = [], 0
            while i < len(d):
                hit = new.get(tuple(d[i:i + 2]))
                out.append(d[i] if hit is None else hit)
                i += 1 if hit is None else 2
            docs[k] = out


@pytest.mark.parametrize("alphabet", [5, 3_000, 64_900, 150_000])
def test_grammar_is_that_of_full_counts_with_fewer_places_counted(monkeypatch, alphabet):
    g = np.random.default_rng(alphabet)
    docs = [np.minimum(g.zipf(1.3, n) - 1, alphabet - 1).tolist() for n in g.integers(1, 900, 90)]
    docs += [[1] * 301, [2, 2], [alphabet - 1], [1, 2] * 80]
    tokens, lengths = np.array(sum(docs, []), np.uint32), np.array(list(map(len, docs)), np.uint32)
    places, count = [], repair._count
    monkeypatch.setattr(repair, "_count", lambda seq, at, *x: places.append(len(at)) or count(seq, at, *x))
    shard = repair.Shard(repair.compress(tokens, lengths))
    rules, left, counted = _plain_rules(docs, repair.BAND, repair.MIN_COUNT)
    assert list(map(tuple, shard.rules.tolist())) == rules and shard.sequence.tolist() == sum(left, [])
    assert shard.symbols.tolist() == list(map(len, left)) and (shard.tokens() == tokens).all()
    assert sum(places) < counted * (0.75 if alphabet > 5 else 1)          # with five symbols most pairs stay frequent


def test_a_word_that_is_its_own_piece_is_kept_once_and_the_cache_stays_small(monkeypatch):
    monkeypatch.setattr(repair, "CACHE_WORDS", 50)
    e = repair.WordEncoder(tokenizer_path())
    e.encode("zebra Zebra ZEBRA, zebra!!")
    assert set(e) == {b"zebra", b"Zebra", b"ZEBRA,", b"zebra!!", b",", b"!!"}
    for t in [*ODD, *(f"x{i}y 漢{i} w{i}," for i in range(300))]:
        assert np.frombuffer(e.encode(t.encode()), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t
        assert len(e) < 80


def test_token_files(spark, encoder):
    docs = documents(spark)
    shards = repair.write_shards(docs, tokenizer_path(), shard_tokens=500)
    assert shards.count() > 8
    got = repair.read_documents(shards).collect()
    rows = sorted(((d.doc_id is not None, d.doc_id or 0, d.text is not None, d.text or ""), d.doc_id, d.text) for d in docs.collect())
    want, start = [], 0
    for _, i, text in rows:
        ids = np.array(encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda x: x[1]) == want
    assert repair.read_documents(repair.write_shards(empty(spark), tokenizer_path())).count() == 0
