import pytest

import corpus_pipeline as P
from conftest import SF_SMALL
from helpers import SCHEMA, documents, empty, items
from lakemart.llm import queries as Q
from lakemart.llm.common import load
from oracle_check import compare, duck
from test_placing import WORD, brute_targets
from test_text import brute_components, brute_fingerprint, brute_hits


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """The odd documents with a benchmark and labels, as a table folder."""
    d = str(tmp_path_factory.mktemp("sf"))
    documents(spark).write.parquet(f"{d}/documents.parquet")
    items(spark).write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    bench = [tuple(r) for r in load(spark, sf_dir, "benchmark").collect()]
    columns = docs.columns
    for name, stage in P.STAGES:
        before = docs.collect()
        docs = P.materialize(stage(spark, docs, sf_dir), "t")
        after = docs.collect()
        if name != "sharding":
            assert docs.columns == columns
        key = lambda rows: sorted(repr((r.doc_id, r.text, r.lang, r.source, r.n_chars, r.score, r._lm_id)) for r in rows)
        if name == "toxicity":                           # no toxic label: nothing goes
            assert key(after) == key(before)
        elif name == "simhash":
            root = brute_components({brute_fingerprint(r.text) for r in before})
            assert len(after) == len(set(root.values()))
            for r in after:
                same = [x.doc_id for x in before if root[brute_fingerprint(x.text)] == root[brute_fingerprint(r.text)] and x.doc_id is not None]
                assert r.doc_id == min(same, default=None)
        elif name == "decontamination":
            clean = [r for r in before if not (lambda n, h, _: h > 0 and 20 * h >= n)(*brute_hits(r.text, bench))]
            assert key(after) == key(clean) and len(clean) < len(before)
        elif name == "mixing":
            size = lambda r: len(WORD.findall(r.text or ""))
            words = {}
            for r in before:
                words[r.source] = words.get(r.source, 0) + size(r)
            for s, t in brute_targets(words).items():
                got = sum(size(r) for r in after if r.source == s)
                largest = max([size(r) for r in before if r.source == s], default=0)
                assert t - 1 <= got <= t + largest
        else:
            assert key(after) == key(before) and {r.shard for r in after} <= set(range(Q.N_SHARDS))
            assert {"shard", "slot", "size", "text_crc32"} <= set(docs.columns) and "SIZE" not in docs.columns


def test_toxic_documents_go_and_clean_ones_stay(spark, tmp_path):
    """Labels with both classes: what operator 5 predicts goes, the planted insults among it, nothing else."""
    import random
    r, d = random.Random(4), str(tmp_path)
    words = [f"plain{i}" for i in range(80)]
    rows = []
    for i in range(240):
        text = [r.choice(words) for _ in range(r.randint(5, 40))]
        rows.append((i, " ".join(text + ["vileslur", "foulname"] if i % 4 == 0 else text), "en", "s", 0))
    rows += [(900, None, "en", "s", 0), (901, "", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    kept = {x.doc_id for x in P.drop_toxic(spark, docs, d).collect()}
    assert kept == {i for i, *_ in rows if i >= 900 or i % 4}
    said = {x.doc_id for x in Q.QUERIES["op5_toxicity"](spark, d).where("predicted = 0").collect()}
    assert kept == said


def test_run_leaves_only_its_result(spark):
    import os
    from lakemart.session import ensure_checkpoint_dir
    base = os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "lakemart-scratch")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    out = P.run(spark, SF_SMALL)
    assert [n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before] == ["pipeline-sharding"] and out.count() > 0


def test_run_on_supplied_and_empty_tables(spark, tmp_path):
    out = P.run(spark, SF_SMALL)
    assert 0 < out.count() and set(load(spark, SF_SMALL, "documents").columns) < set(out.columns)
    d = str(tmp_path)
    empty(spark).write.parquet(f"{d}/documents.parquet")
    items(spark).write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert P.run(spark, d).count() == 0 and len(SCHEMA) > 0


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_registered_queries(spark, name):
    r = compare(spark, duck(SF_SMALL), name, Q.QUERIES[name], Q.ORACLE.get(name), SF_SMALL)
    assert r["ok"] is True if name in Q.ORACLE else r["rows"] > 0, r


def test_held_out_toxicity(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    rows = Q.QUERIES["op5_toxicity"](spark, sf).join(load(spark, sf, "labels"), "doc_id").where("held_out").collect()
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    toxic = [r.score for r in rows if r.toxic == 1]
    assert sum(toxic) / len(toxic) > 5 * sum(r.score for r in clean) / len(clean)
