import hashlib
import pickle
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import SCHEMA, documents, empty, items
from lakemart.llm import contamination, perplexity, simhash, suffixes, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# -- contamination --------------------------------------------------------------------------------

def brute_hits(text, bench):
    words, hit, found = TERM.findall((text or "").translate(LOWER)), set(), set()
    for item, q in bench:
        w = TERM.findall((q or "").translate(LOWER))
        k = min(13, len(w))
        for win in {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else ():
            for i in range(len(words) - k + 1):
                if tuple(words[i:i + k]) == win:
                    hit |= set(range(i, i + k))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("chars", [8_000_000, 400])       # one automaton, and several passes
def test_contamination_against_brute_force(spark, chars):
    docs, bench = documents(spark), items(spark)
    got = contamination.contaminated(docs, bench, automaton_chars=chars).collect()
    assert len(got) == docs.count()
    pairs = [tuple(r) for r in bench.collect()]
    known = {}
    for r in got:
        if r.text not in known:
            known[r.text] = brute_hits(r.text, pairs)
        n, hit, found = known[r.text]
        assert (r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) == (n, hit, len(found), found, hit > 0 and 20 * hit >= n), r.doc_id
        text = "".join(r.text[s.start:s.end] + " " for s in r.hit_spans) if r.text else ""
        assert len(TERM.findall(text.translate(LOWER))) == hit
    assert any(r.contaminated for r in got) and any(not r.contaminated and r.n_words for r in got)


def test_contamination_of_empty_tables(spark):
    assert contamination.contaminated(empty(spark), items(spark)).count() == 0
    clean = contamination.contaminated(documents(spark), items(spark).limit(0))
    assert clean.where("n_hit > 0 or contaminated").count() == 0


# -- simhash --------------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    order = sorted(parent)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[find(b)] = find(a)
    return {f: find(f) for f in order}


def test_simhash_components(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    fp = {r.text: brute_fingerprint(r.text) for r in rows}
    root = brute_components(set(fp.values()))
    low = {}
    for r in rows:
        c = root[fp[r.text]]
        low[c] = min((x for x in (low.get(c), r.doc_id) if x is not None), default=None)
    got = simhash.near_duplicates(docs).collect()
    assert sorted(map(repr, ((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got))) == \
        sorted(map(repr, ((r.doc_id, fp[r.text], low[root[fp[r.text]]]) for r in rows)))
    left = simhash.drop_near_duplicates(docs)
    kept = left.collect()
    assert left.columns == [c for c in docs.columns if c != "_lm_id"] and len(kept) == len(set(root.values()))
    assert {root[fp[r.text]] for r in kept} == set(root.values())
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_large_buckets_are_cut_further_and_lose_no_link(spark):
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(4)]
    fps = {b for b in base}
    for b in base[:2]:                                   # dense neighbourhoods and chains of links
        x = b
        for _ in range(250):
            fps.add(b ^ sum(1 << r.randrange(64) for _ in range(2)))
            x ^= 1 << r.randrange(64)
            fps.add(x)
    fps |= {r.getrandbits(64) for _ in range(300)}
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    want = brute_components(fps)
    for bucket in (4096, 30):
        edges = simhash.bucket_edges(df, bucket=bucket)
        assert all(((a ^ b) & (2**64 - 1)) and a > b for a, b in edges.collect())
        roots = {n & (2**64 - 1): q & (2**64 - 1) for n, q in simhash.components(edges).collect()}
        groups = {}
        for f in fps:
            groups.setdefault(want[f], set()).add(roots.get(f, f))
        assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


# -- repeats --------------------------------------------------------------------------------------

def brute_cut(rows, length):
    first, out = {}, {}
    for i, t in rows:
        b, k = (t or "").encode(), (1 << 63) if i is None else i
        for p in range(len(b) - length + 1):
            first[b[p:p + length]] = min(k, first.get(b[p:p + length], k))
    for i, t in rows:
        b, k = (t or "").encode(), (1 << 63) if i is None else i
        m = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < k:
                m[p:p + length] = b"\1" * length
        out[i, t] = (sum(m), hashlib.sha256(bytes(c for c, f in zip(b, m) if not f)).hexdigest())
    return out


@pytest.mark.parametrize("records", [10_000, 7])
def test_repeats_against_brute_force(spark, records):
    r = random.Random(3)
    make = lambda n, a: "".join(r.choice(a) for _ in range(n))
    passage, long = make(60, "abcdefgh "), make(280_000, "abcdefghij")
    rows = [(1, make(200, "abcd") + passage), (2, "zz" + passage + "q" * 80), (3, "q" * 60), (4, None), (5, ""), (6, "x" * 49), (7, "x" * 50), (8, "x" * 50),
            (9, long), (10, "é" + long[100_000:270_000] + "ü" + long[5:60]), (10, "other " + passage), (10, "other " + passage), (None, passage * 2),
            (None, "x" * 51 + passage), (11, "y" * 3000), (12, "y" * 20_000)]
    rows += [(20 + i, make(30, "abc") + passage[:50 + i % 11] + make(30, "abc")) for i in range(60)]
    rows += [(1000 + i, make(400, "a") + make(5, "ab") + make(100, "a")) for i in range(20)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        df = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, KEPT string").repartition(5)
        got = suffixes.remove_repeats(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_cut(rows, 50)
    assert len(got) == len(rows)
    for x in got:
        assert (sum(s.end - s.start for s in x.removed), hashlib.sha256(bytes(x.kept)).hexdigest()) == want[x.doc_id, x.text], x.doc_id
    assert suffixes.remove_repeats(empty(spark)).count() == 0


def test_repeats_with_another_length(spark):
    docs = documents(spark)
    got = suffixes.remove_repeats(docs, length=24, gram=9).collect()
    want = brute_cut([tuple(x) for x in docs.select("doc_id", "text").collect()], 24)
    for x in got:
        assert sum(s.end - s.start for s in x.removed) == want[x.doc_id, x.text][0], x.doc_id


def test_repeats_rank_a_share_of_the_texts_at_a_time(spark, monkeypatch):
    """Short phrases that documents share agree on 20 bytes and not on 50: no sort may hold a row for each position or each window."""
    r = random.Random(12)
    make = lambda n: "".join(r.choice("abcdefghijklmnop ") for _ in range(n))
    phrases, passages = [make(30) for _ in range(40)], [make(70) for _ in range(5)]
    rows = [(i, "".join(r.choice(phrases) + make(r.randint(20, 40)) for _ in range(20)) + (r.choice(passages) + make(9) if i % 3 == 0 else "")) for i in range(300)]
    size, sorted_at_once, passes = sum(len(t) for _, t in rows), [], []
    real, written = suffixes.map_arrow, suffixes.materialize

    def counted(df, fn, schema):
        out = real(df, fn, schema)
        if schema == suffixes._RANKED:
            sorted_at_once.append(out.count())
        return out

    monkeypatch.setattr(suffixes, "map_arrow", counted)
    monkeypatch.setattr(suffixes, "materialize", lambda df, name: passes.append(name) or written(df, name))
    monkeypatch.setattr(suffixes, "SPARSE", 1000, raising=False)
    monkeypatch.setattr(suffixes, "FEW", 1, raising=False)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffixes.remove_repeats(docs).collect()
    want = brute_cut(rows, 50)
    assert {x.doc_id: sum(s.end - s.start for s in x.removed) for x in got} == {i: want[i, t][0] for i, t in rows}
    assert sum(n for n, _ in want.values()) > 1000
    assert max(sorted_at_once) < size / 24, (size, sorted_at_once)              # one position in 16 is chosen
    assert sum(name.startswith("repeat-windows") for name in passes) > 2, passes
    assert all(x < size / 500 for x in sorted_at_once[suffixes.SLICES:]), (size, sorted_at_once)

# -- perplexity -----------------------------------------------------------------------------------

def test_base_metrics():
    r = random.Random(1)
    for _ in range(300):
        t = "".join(r.choice(["a", "b ", " ", "\n", "x y z ", "#", "é|", "\t", "a b c d e f g h i ", " "]) for _ in range(r.randint(0, 120)))
        w = WORD.findall(t)
        c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        m = {i + j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert perplexity.base_metrics(t) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(m))


def brute_kneser_ney(texts):
    """{context: {character: p}} by the textbook recursion, on plain dictionaries."""
    counts = {5: Counter()}
    for t in texts:
        s = "\2" * 4 + " ".join(t.split()) + "\3"
        counts[5].update(s[i:i + 5] for i in range(len(s) - 4))
    for m in (4, 3, 2, 1):
        counts[m] = Counter(g[1:] for g in counts[m + 1])
    n = {m: Counter(c.values()) for m, c in counts.items()}

    def discount(m, c):
        k, q = min(c, 3), n[m]
        y = q[1] / (q[1] + 2 * q[2]) if q[1] + q[2] else 0.5
        return max(0.1, min(k - 0.1, k - (k + 1) * y * q[k + 1] / q[k] if q[k] else k / 2))

    groups = {m: {} for m in counts}
    for m, c in counts.items():
        for g, x in c.items():
            groups[m].setdefault(g[:-1], {})[g[-1]] = x

    def p(context, char, m):
        g = groups[m].get(context[-(m - 1):] if m > 1 else "")
        low = (lambda: p(context, char, m - 1)) if m > 1 else (lambda: 1 / (len(counts[1]) + 1))
        if g is None:
            return low()
        total = sum(g.values())
        own = max(0, g[char] - discount(m, g[char])) if char in g else 0
        return own / total + sum(discount(m, x) for x in g.values()) / total * low()
    return p


def test_model_equals_the_textbook_and_slices_agree(spark):
    texts = ["the cat sat on the mat " * 3 + f"{i}" for i in range(5)] + ["a dog sat on the log", "the end"]
    docs = spark.createDataFrame([("l:en", t) for t in texts] + [("l:x", "zzz")], "lang string, text string")
    grams, contexts = perplexity.kneser_ney(docs)
    p = brute_kneser_ney(texts)
    for r in grams.where("lang = 'l:en'").collect():
        assert abs(np.exp(r.value) - p(r.gram[:-1], r.gram[-1], len(r.gram))) < 1e-9, r
    probe = spark.createDataFrame([("l:en", t) for t in [*texts, "unseen words, the cät", "the the"]] + [("l:x", "zz y")], "_lm_lang string, text string")
    score = {}
    for entries in (perplexity.SLICE, 40):
        model, slices = perplexity.store(grams, contexts, entries)
        assert (slices > 1) == (entries == 40)
        score[entries] = {r.text: (r.nll, r.n_predicted) for r in perplexity.perplexities(probe, model, slices).collect()}
        for row in model.collect():
            keys = np.frombuffer(row["keys"], "<u8")
            assert (np.diff(keys.astype(float)) >= 0).all() and (keys >> 56 == row["chunk"]).all() and len(row["values"]) == 8 * len(keys)
    for t, (nll, n) in score[perplexity.SLICE].items():
        assert score[40][t][1] == n == len(t) + 1 and abs(score[40][t][0] - nll) < 1e-6
        if t != "zz y":
            s = "\2" * 4 + t.strip() + "\3"
            assert abs(nll + sum(np.log(p(s[i:i + 4], s[i + 4], 5)) for i in range(len(s) - 4))) < 1e-6, t


def test_slices_pass_by_the_held_texts_one_at_a_time(spark, monkeypatch):
    r = random.Random(8)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(60)) for _ in range(60)] + ["", "abc abd " * 40]
    docs = spark.createDataFrame([("l:en", t) for t in texts], "_lm_lang string, text string")
    grams, contexts = perplexity.kneser_ney(docs.withColumnRenamed("_lm_lang", "lang"))
    one, slices = perplexity.store(grams, contexts)
    assert slices == 1
    want = {x.text: (x.nll, x.n_predicted) for x in perplexity.perplexities(docs, one, 1).collect()}
    cut, slices = perplexity.store(grams, contexts, 4000)
    assert slices >= 3
    for held in (perplexity.HELD, 200):                  # sums of integers: equal to the last bit, whatever is held together
        for x in perplexity.perplexities(docs.repartition(9), cut, slices, held).collect():
            assert (x.nll, x.n_predicted) == want[x.text], x

    passes, most = [], []                                # the same pass in this process, task by task
    monkeypatch.setattr(perplexity, "map_arrow", lambda df, fn, schema: passes.append(fn) or spark.createDataFrame([], schema))
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: pytest.fail("the model is broadcast"))
    monkeypatch.setattr(type(cut), "collect", lambda self: pytest.fail("the model is collected"))
    opened = perplexity._rows
    monkeypatch.setattr(perplexity, "_rows", lambda f: most.append(len(perplexity._open)) or opened(f))
    perplexity.perplexities(docs, cut, slices, 150)
    assert len(passes) == 1
    for at in range(0, len(texts), 5):
        part = texts[at:at + 5]
        batches = [pa.RecordBatch.from_pydict({"_lm_lang": ["l:en"] * len(x), "text": x}) for x in (part[:2], part[2:]) if x]
        for b in passes[0](iter(batches)):
            for text, nll, n in zip(b.column("text").to_pylist(), b.column("nll").to_pylist(), b.column("n_predicted").to_pylist()):
                assert (nll, n) == want[text], text
    assert most and max(most) == 0                       # the slice before is let go before the next one is read


def test_equal_texts_score_alike_and_alike_texts_stay(spark):
    text = "the cat sat on the mat and a dog ran over to the other side of it while nobody was looking at them"
    rows = [(i, text if i % 3 else f"{text} number {i}", "en") for i in range(40)] + [(100 + i, text, "fr") for i in range(30)]
    out = {x.doc_id: x for x in perplexity.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6),
                                                         slice_entries=300).collect()}
    assert len({out[i].log_perplexity for i in range(40) if i % 3}) == 1
    assert len({out[100 + i].log_perplexity for i in range(30)}) == 1 and all(out[100 + i].kept for i in range(30))


def test_quality_bands(spark):
    r = random.Random(5)
    good = ["".join(r.choice(["the ", "cat ", "sat ", "on ", "a ", "mat ", "and ", "ran "]) for _ in range(60)) for _ in range(80)]
    noise = ["".join(chr(r.randrange(33, 1000)) + " " * (r.random() < 0.2) for _ in range(400)) for _ in range(2)]
    rows = [(i, t, "en") for i, t in enumerate(good + noise)] + [(500, None, "en"), (501, "", None), (502, "few words", None), (503, "a b c d e f g h " * 9, "en")]
    out = {x.doc_id: x for x in perplexity.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(out[i].kept for i in range(80)) >= 76 and not any(out[80 + i].kept for i in range(2))
    assert all(out[i].base_failed and not out[i].kept for i in (500, 501, 502, 503))
    again = perplexity.judge_quality(documents(spark))
    assert again.count() == documents(spark).count() and "text" not in again.columns
    assert perplexity.judge_quality(empty(spark)).count() == 0


def test_bands_are_outer_fences_of_each_side(spark):
    r = random.Random(5)
    good = [["the", "cat", "sat", "on", "a", "mat", "and", "ran"][r.randrange(8)] for _ in range(6000)]
    texts = [" ".join(good[60 * i:60 * i + 60]) for i in range(100)]
    texts += ["".join(c if r.random() > share / 200 else chr(r.randrange(400, 440)) for c in texts[share]) for share in range(1, 9)]
    out = perplexity.judge_quality(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")).collect()
    x = sorted(o.log_perplexity for o in out if not o.base_failed)
    q1, q2, q3 = (x[-(-len(x) * k // 4) - 1] for k in (1, 2, 3))
    low, high = q1 - 6 * (q2 - q1), q3 + 6 * (q3 - q2)
    assert all(o.kept == (not o.base_failed and low <= o.log_perplexity <= high) for o in out)
    assert any(high < v <= q3 + 10 * (q3 - q2) for v in x)


# -- toxicity -------------------------------------------------------------------------------------

def test_block_max_search_is_exact():
    g = np.random.default_rng(7)
    weight = np.round(g.random(40), 1) + 0.01                           # many ties
    examples = [(np.sort(g.choice(40, g.integers(1, 6), replace=False)).astype(np.int32), None) for _ in range(700)]
    examples = [(c, g.integers(1, 4, len(c)).astype(np.int32)) for c, _ in examples]
    index = pickle.loads(pickle.dumps(toxicity.BlockMaxIndex(examples, weight, block=16)))
    dense = np.zeros((700, 40))
    for i, (c, tf) in enumerate(examples):
        dense[i, c] = (1 + np.log(tf)) * weight[c]
    dense /= np.sqrt((dense * dense).sum(axis=1))[:, None]
    for i, (cols, tf) in enumerate(examples[:150]):
        s = np.round(dense @ dense[i], 12)
        want = sorted((-x, j) for j, x in enumerate(s.tolist()) if x > 0)[:10]
        got = index.search(cols, tf, 10)
        assert np.allclose([x for _, x in got], [-x for x, _ in want], atol=2e-12)
        assert [j for j, _ in got] == [j for _, j in want] or np.ptp([x for x, _ in want]) < 2e-12 or len({*[round(x, 10) for x, _ in want]}) < len(want)


def test_toxicity_learns_and_explains(spark):
    r = random.Random(6)
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        t = [r.choice(words) for _ in range(r.choice([3, 30, 3000]))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                t[r.randrange(len(t))] = r.choice(["nastyword", "Foulthing", "nastyish", "foulness"])
        rows.append((i, " ".join(t), "x"))
        labels.append((i, int(bad)))
    rows += [(900, None, "x"), (901, "", "x"), (0, rows[0][1], "x")]
    labels += [(3, None), (None, 1), (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Score string")
    train = spark.createDataFrame([x for x in labels if x[0] is None or x[0] % 4], "doc_id long, toxic int")
    out = toxicity.score_documents(docs, toxicity.fit(docs, train)).collect()
    assert len(out) == len(rows)
    held = [x for x in out if x.doc_id % 4 == 0 and x.doc_id < 400]
    assert all(x.predicted == (x.doc_id % 5 == 0) for x in held)
    assert all(0 <= x.score <= 1 for x in out) and all(not x.predicted for x in out if not x.text)
    assert all(e.label == 1 for x in held if x.predicted for e in list(x.evidence)[:1])


def test_toxicity_searches_documents_with_any_known_term(spark):
    """A word of one toxic example finds that example; no term of the examples is left out."""
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(12))) for i in range(60)]
    rows = [(i, t + " vilething" if i == 7 else t + " commonslur" if i < 20 else t) for i, t in rows]
    docs = spark.createDataFrame([*rows, (100, "xylo vilething zzz"), (101, "alpha beta"), (102, "qq")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i < 20)) for i in range(60)], "doc_id long, toxic int"))
    assert set(model.features.value.tolist()) == set(toxicity.term_hashes([t for _, t in rows])[0].tolist())
    out = {x.doc_id: x for x in toxicity.score_documents(docs, model).collect()}
    assert out[100].evidence[0].doc_id == 7 and out[100].evidence[0].label == 1
    assert out[101].evidence and not out[102].evidence


def test_toxicity_without_labels_or_documents(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, toxicity.fit(docs, none)).where("score > 0 or predicted = 1").count() == 0
    some = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.score_documents(empty(spark), toxicity.fit(empty(spark), some)).count() == 0


def test_schema_of_the_fixture_clashes(spark):
    """The fixture really holds names that operators use."""
    assert {"score", "shard", "_lm_id", "kept"} <= set(spark.createDataFrame([], SCHEMA).columns)
    assert documents(spark).agg(F.count("text")).first()[0] < documents(spark).count()


def kept_by_brute_force(rows, length=50):
    """Kept bytes of each row: a byte goes if a 50-byte string over it also starts in a row with a smaller id."""
    owner, none = {}, 1 << 63
    cells = [(none if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in cells:
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            owner[s] = min(owner.get(s, none), d)
    out = []
    for d, b in cells:
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if owner[b[i:i + length]] < d:
                cover[i:i + length] = b"\x01" * length
        out.append(bytes(x for x, c in zip(b, cover) if not c))
    return out


def test_repeats_of_rows_that_share_an_id_or_have_none(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    shared = [" ".join(word() for _ in range(12)) for _ in range(6)]
    rows = [(i, " ".join([word(), r.choice(shared), word()])) for i in range(20)]
    rows += [(None, " ".join([word() for _ in range(r.randint(0, 15))] + ([r.choice(shared)] if i % 3 == 0 else []))) for i in range(2000)]
    rows += [(9, " ".join([word() for _ in range(10)] + ([shared[1]] if i % 2 else []))) for i in range(300)]
    rows += [(9, rows[-1][1]), (None, None), (None, ""), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = Counter((x.doc_id, x.text, bytes(x.kept)) for x in suffixes.remove_repeats(docs).collect())
    assert got == Counter((d, t, k) for (d, t), k in zip(rows, kept_by_brute_force(rows)))


def test_four_differing_bits_are_found_and_more_are_refused(spark):
    base = 0x123456789ABCDEF0
    fps = [base, base ^ (1 | 1 << 14 | 1 << 27 | 1 << 40), base ^ (1 << 3 | 1 << 19 | 1 << 35 | 1 << 51 | 1 << 60)]
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    assert {tuple(sorted(e)) for e in simhash.bucket_edges(df, max_bits=4).collect()} == {tuple(sorted(fps[:2]))}
    with pytest.raises(ValueError):
        simhash.bucket_edges(df, max_bits=5)


def test_toxicity_fit_by_brute_force(spark):
    """Frequencies, chi-square weights, neighbours, votes and the isotonic fit, computed again from words."""
    r = random.Random(11)
    words = [f"v{i}" for i in range(50)]
    rows = []
    for i in range(120):
        t = [r.choice(words) for _ in range(r.randint(4, 30))]
        rows.append((i, " ".join(t + ["slur"] * (i % 4 == 0 and r.random() < 0.9) + ["rude"] * (r.random() < 0.1))))
    rows += [(200, None), (201, "!!"), (202, "v1 v2 unknown")]
    labels = {i: int(i % 4 == 0) for i in range(0, 100)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    k = 5
    model = toxicity.fit(docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), k=k)
    got = {x.doc_id: x for x in toxicity.score_documents(docs, model, k).collect()}

    count = {d: Counter(re.findall(r"[a-z0-9]+", (t or "").lower())) for d, t in rows}
    terms = sorted({w for d in labels for w in count[d]})
    n1, n0 = sum(labels.values()), len(labels) - sum(labels.values())
    weight = {}
    for w in terms:
        df = sum(w in c for c in count.values())
        a1, a0 = (sum(w in count[d] for d in labels if labels[d] == c) for c in (1, 0))
        den = (a0 + a1) * (n0 + n1 - a0 - a1) * n0 * n1
        chi2 = (n0 + n1) * (a1 * (n0 - a0) - a0 * (n1 - a1)) ** 2 / den if den else 0.0
        weight[w] = (1 + np.log((len(rows) + 1) / (df + 1))) * max(chi2, toxicity.LEAST)

    def vector(c):
        v = {w: (1 + np.log(n)) * weight[w] for w, n in c.items() if w in weight}
        s = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / s for w, x in v.items()}

    vectors = {d: vector(count[d]) for d in labels}

    def near(c, but=None):
        q = vector(c)
        s = sorted(((round(sum(x * v.get(w, 0.0) for w, x in q.items()), 9), d) for d, v in vectors.items() if d != but), reverse=True)
        return [(d, x) for x, d in s if x > 0]

    def raw(found):
        w = [1 / (1.05 - min(1.0, x)) for _, x in found]
        return (sum(a * labels[d] for a, (d, _) in zip(w, found)) + n1 / len(labels)) / (sum(w) + 1)

    votes = np.array([raw(near(count[d], d)[:k]) for d in labels])
    knots = toxicity.isotonic(votes, np.array(list(labels.values()), float), np.ones(len(labels)))
    for d, _ in rows:
        found = near(count[d])
        if len(found) > k and found[k - 1][1] == found[k][1]:
            continue                                               # which of equally near ones votes is the hash's choice
        want = float(np.interp(raw(found[:k]), *knots)) if found else n1 / len(labels)
        assert abs(got[d].score - want) < 1e-6, d
        assert np.allclose(sorted(e.similarity for e in got[d].evidence), sorted(x for _, x in found[:k]), atol=1e-6)
