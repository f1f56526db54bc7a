"""Operators 11 to 13 against brute force."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import documents, empty
from lakemart.llm import centroids, heavylight, manifest


# -- 11: shared n-grams -----------------------------------------------------------------------------

def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    k = min(k, len(w))
    return frozenset(b" ".join(w[j:j + k]) for j in range(len(w) - k + 1)) if w else frozenset()


def brute_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[top(a)] = top(b)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[top(i)].append(d)
    name = lambda i, d: min((x for x in ids[top(i)] if x is not None), default=None) if sets[i] else d
    return sorted(((d, len(sets[i]), name(i, d)) for i, (d, _) in enumerate(rows)), key=str)


def edited_copies(seed, sizes):
    """Groups of texts that differ by a few words, so that many pairs are just above or below the threshold."""
    r = random.Random(seed)
    vocabulary, rows = [f"w{i}" for i in range(40)], []
    for _ in range(16):
        base = [r.choice(vocabulary) for _ in range(r.choice(sizes))]
        for _ in range(r.randint(1, 20)):
            v = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                at, kind = r.randrange(len(v)), r.random()
                if kind < 0.4:
                    v[at] = r.choice(vocabulary)
                elif kind < 0.6 and len(v) > 1:
                    del v[at]
                else:
                    v.insert(at, r.choice(vocabulary))
            rows.append((len(rows), " ".join(v).upper() if r.random() < 0.1 else " ".join(v)))
    return rows + [(None, rows[3][1]), (None, "solo x y"), (9999, None), (9998, ""), (9997, " \n"), (5, rows[9][1]), (9996, "two words")]


@pytest.mark.parametrize("light", [None, 0, 14])
def test_similar_sets_by_brute_force(spark, monkeypatch, light):
    """Whatever the boundary: chosen by cost, all sets heavy, or many light."""
    if light is not None:
        monkeypatch.setattr(heavylight, "boundary", lambda *_: light)
    monkeypatch.setattr(heavylight, "SHARE", 0.0)
    rows = edited_copies(light or 1, [2, 4, 7, 9, 12, 15, 18, 60] if light else [4, 8, 16, 25, 60, 120])
    got = heavylight.similar_sets(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows)


def test_similar_sets_of_odd_rows(spark):
    docs = documents(spark)
    got = heavylight.similar_sets(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert heavylight.similar_sets(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        heavylight.similar_sets(docs, percent=40)


def test_shingle_hashes_do_not_depend_on_the_batch():
    texts = ["A b  c d e", None, "", "a b c d e f", "x", "\tX\n", "\u00e9t\u00e9 \u00c9T\u00c9 a b c", "a b c d"] * 3
    together = [s.tolist() for s in heavylight.shingle_sets(pa.array(texts))]
    assert together == [s.tolist() for t in texts for s in heavylight.shingle_sets(pa.array([t], pa.string()))]
    assert together == [s.tolist() for s in heavylight.shingle_sets(pa.array(["skip", *texts]).slice(1))]
    assert [len(s) for s in together] == [len(shingles(t)) for t in texts]
    assert together[7] == sorted(set(together[0]) & set(together[3]))[:1] or len(set(together[7]) & set(together[0])) == 1
    assert together[4] == together[5] and together[6] != together[3]


def test_sketches_bound_the_difference():
    g = np.random.default_rng(3)
    for _ in range(200):
        pool = g.integers(0, 1 << 63, 400, dtype=np.uint64)
        x, y = (np.unique(g.choice(pool, g.integers(1, 300))) for _ in range(2))
        assert heavylight.least_difference(heavylight.sketch(x), heavylight.sketch(y)) <= len(np.setxor1d(x, y))


def test_the_boundary_follows_the_cost():
    assert heavylight.boundary({}) == 0
    assert heavylight.boundary({3: 1000}) >= 3                     # equal sets only: one subset each
    assert heavylight.boundary({20: 1000}) < 20                    # 20 sets enumerate hundreds of subsets
    assert [heavylight.need(n, n) for n in (1, 6, 7, 13, 14)] == [1, 6, 7, 12, 13]


# -- 12: clusters -----------------------------------------------------------------------------------

def brute_clusters(rows, k=centroids.K, rounds=centroids.ROUNDS):
    vectors = [(v, [math.floor(256 * float(x)) for x in e]) for v, e in rows
               if e is not None and len(e) == 64 and all(x is not None and math.isfinite(256 * x) for x in e)]
    key = lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    at = [q for _, q in sorted(vectors, key=lambda r: (key(r), r[1]))[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), i) for i, c in enumerate(at))

    for _ in range(rounds):
        of = defaultdict(list)
        for _, q in vectors:
            of[nearest(q)[1]].append(q)
        at = [[sum(x) // len(of[i]) for x in zip(*of[i])] if of[i] else c for i, c in enumerate(at)]
    return sorted(((v, nearest(q)[1], nearest(q)[0]) for v, q in vectors), key=str), at


def test_clusters_by_brute_force(spark):
    g = np.random.default_rng(5)
    centres = g.normal(0, 0.3, (9, 64))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 9] + g.normal(0, 0.05, 64)]) for i in range(180)]
    rows += [(500 + i, rows[3][1]) for i in range(30)]                        # a very common vector
    rows += [(3, rows[4][1]), (None, rows[5][1]), (None, None), (700, []), (701, rows[0][1][:63]), (702, rows[0][1] + [0.0]),
             (703, [None] + rows[0][1][1:]), (704, [float("nan")] * 64), (705, [float("inf")] + rows[0][1][1:]), (706, [0.0] * 64), (707, [-1e-30] * 64), (708, [1e307] * 64)]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cluster string").repartition(4)
    for k, lead in ((40, 16), (7, 1), (5, 64)):
        got, at = centroids.cluster(vectors, k=k, lead=lead)
        want, c = brute_clusters(rows, k)
        assert at == c and sorted(map(tuple, got.collect()), key=str) == want
    total = centroids.with_inertia(got).collect()
    assert {r.inertia for r in total} == {sum(d for _, _, d in want)}
    assert all(r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) for r in total)


def test_clusters_of_huge_components_are_exact(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([1e300, -3e305, 5e9, 0.25, -1.0]) if r.random() < 0.1 else r.random() for _ in range(64)]) for i in range(30)]
    rows += [(100 + i, [r.random() * 2e6 for _ in range(64)]) for i in range(30)]
    got, at = centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), k=6)
    want, c = brute_clusters(rows, 6)
    assert at == c
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((v, i, d if d < 1 << 63 else None) for v, i, d in want), key=str)
    assert centroids.with_inertia(got).count() == 60
    none, at = centroids.cluster(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"))
    assert at == [] and centroids.with_inertia(none).count() == 0
    few, at = centroids.cluster(spark.createDataFrame([(1, [0.5] * 64), (2, [0.1] * 64)], "vec_id long, embedding array<float>"))
    assert len(at) == 2 and sorted((x.cluster, x.distance) for x in few.collect()) == [(0, 0), (1, 0)]


def test_the_filter_never_drops_the_nearest():
    """Bounds are below the exact distances, so only verified centroids decide."""
    g = np.random.default_rng(1)
    q = np.floor(g.normal(0, 80, (300, 64)))
    axes = np.linalg.qr(g.normal(size=(64, 64)))[0]
    c = [[int(x) for x in row] for row in np.floor(g.normal(0, 80, (25, 64)))]
    near = centroids.Nearest(c, axes, 12)
    front, rest = centroids._split(q, axes, 12)
    exact = ((q[:, None, :] - np.array(c)[None]) ** 2).sum(axis=2)
    assert (near.bounds(front, rest) <= exact).all()
    cluster, distance = near.search(q, front, rest)
    assert cluster.tolist() == exact.argmin(axis=1).tolist() and [int(x) for x in distance] == exact.min(axis=1).tolist()


# -- 13: Merkle manifest ------------------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def cell(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def reduce_nodes(nodes, arity=3):
    proofs, at = [""] * len(nodes), list(range(len(nodes)))
    while len(nodes) > 1:
        for i, j in enumerate(at):
            first = j // arity * arity
            proofs[i] += "".join(nodes[first:j] + nodes[j + 1:first + arity])
        nodes, at = [H(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)], [j // arity for j in at]
    return nodes[0], proofs


def brute_manifest(rows, arity=3):
    by = defaultdict(list)
    for d, source, text in rows:
        by[source].append(((d is not None, d or 0), H(cell(d), cell(source), cell(text)), d))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    sub, own = {}, {}
    for s in sources:
        leaves = sorted(by[s], key=lambda x: x[:2])
        sub[s], proofs = reduce_nodes([x[1] for x in leaves], arity)
        own[s] = [(x[2], x[1], p) for x, p in zip(leaves, proofs)]
    root, upper = reduce_nodes([sub[s] for s in sources], arity)
    return sorted(((d, leaf, sub[s], root, p + u) for s, u in zip(sources, upper) for d, leaf, p in own[s]), key=str)


@pytest.mark.parametrize("levels, arity", [(5, 3), (1, 3), (2, 2)])
def test_manifest_by_brute_force(spark, levels, arity):
    r = random.Random(levels)
    rows = [(i, r.choice([None, "", "a", "b", "\u00e9", "z"]) if i < 60 else "hot", r.choice([None, "", f"text {i}\nmore"])) for i in range(200)]
    rows += [(None, "solo", None), (7, "hot", "same id"), (7, "hot", "same id"), (7, "hot", "another"), (None, "hot", "x"), (201, "z", "long " * 20_000)]
    df = spark.createDataFrame([(*x, "l") for x in rows], "doc_id long, source string, text string, leaf string").repartition(5)
    got = manifest.manifest(df, "doc_id", "source", manifest.row_digest(["doc_id", "source", "text"]), {"extra": F.col("text")}, arity, levels)
    found = got.select("doc_id", "leaf", "subroot", "root", manifest.siblings(F.col("proof")).alias("s"),
                       manifest.folded(F.col("leaf"), F.col("proof")).alias("folded"), "extra").collect()
    assert sorted((tuple(x[:5]) for x in found), key=str) == brute_manifest(rows, arity)
    assert all(x.folded == x.root for x in found) and sorted(str(x.extra) for x in found) == sorted(str(x[2]) for x in rows)


def test_manifest_of_few_rows_and_odd_columns(spark):
    leaf = manifest.row_digest(["doc_id", "source", "text"])
    one = spark.createDataFrame([(1, None, "a")], "doc_id long, source string, text string")
    r = manifest.manifest(one, "doc_id", "source", leaf).first()
    assert r.leaf == r.subroot == r.root == H(cell(1), cell(None), cell("a")) and r.proof == []
    assert manifest.manifest(empty(spark), "doc_id", "source", leaf).count() == 0
    docs = documents(spark)
    got = manifest.manifest(docs, "doc_id", "source", leaf)
    found = got.select("doc_id", "leaf", "subroot", "root", manifest.siblings(F.col("proof"))).collect()
    assert sorted(map(tuple, found), key=str) == brute_manifest([(r.doc_id, r.source, r.text) for r in docs.collect()])


def test_a_changed_row_does_not_verify(spark):
    rows = [(i, "s", f"line\n{i}" if i % 2 else "flat") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    shown = manifest.row_digest(["doc_id", "text"], {"text": F.translate("text", "\n", "")})
    got = manifest.manifest(df, "doc_id", "source", manifest.row_digest(["doc_id", "text"]), {"shown": shown})
    ok = got.select("doc_id", (manifest.folded(F.col("shown"), F.col("proof")) == F.col("root")).alias("ok")).collect()
    assert all(r.ok == (r.doc_id % 2 == 0) for r in ok)
