"""Driver contract and oracle agreement at sf0.001 (fast subset of the driver check)."""

import pytest

import __spark_entry__ as E
from lakemart.harness import ORACLE as HARNESS_SQL, QUERIES as HARNESS
from oracle_check import compare, duck

from conftest import SF_SMALL

E.queries()                 # loads the harness
QUERIES, ORACLE = dict(HARNESS), dict(HARNESS_SQL)
ROWS_ONLY: set = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "media_geral" in df.columns


def test_every_query_has_an_oracle_unless_rows_only():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan, "no Python in any query plan"
    r = compare(spark, con, name, lambda *_: df, ORACLE.get(name), SF_SMALL)
    assert r.get("ok") is not False, r
    assert "type_note" not in r, r


@pytest.mark.parametrize("gone", [["lakemart/llm", "corpus_pipeline.py"], ["lakemart/llm"], ["corpus_pipeline.py"]])
def test_copy_without_the_optional_part_still_lists_the_rest(tmp_path, gone):
    import shutil
    import subprocess
    import sys
    from pathlib import Path
    root = Path(E.__file__).resolve().parent
    for part in ("lakemart", "corpus_pipeline.py", "__spark_entry__.py"):
        if part not in gone and (root / part).exists():
            src = root / part
            ignore = lambda d, names: [n for n in names if n == "__pycache__" or f"{Path(d).name}/{n}" in gone]
            shutil.copytree(src, tmp_path / part, ignore=ignore) if src.is_dir() else shutil.copy(src, tmp_path / part)
    code = "import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); assert set(o) <= set(q); print(len(q), any(k[:2] == 'op' for k in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, has_ops = out.stdout.split()
    assert int(n) >= len(HARNESS) and has_ops == str("lakemart/llm" not in gone and (root / "lakemart/llm").exists())
