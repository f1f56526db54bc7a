"""run_lakehouse end to end on the exam fixture laid out as raw releases."""

import pytest
from pyspark.sql import functions as F

from lakemart.operators import DataQualityError
from lakemart.plans.exam import adhoc
from lakemart.plans.fixtures import exam_bronze, exam_bronze_columns, table, write_exam_raw
from lakemart.plans.lakehouse import LakehouseConfig, run_lakehouse

from conftest import SF_SMALL


def test_lakehouse_runs_all_stages(spark, scratch):
    inputs = write_exam_raw(exam_bronze_columns(table(spark, SF_SMALL, "orders")), scratch("raw"))
    cfg = LakehouseConfig(inputs=inputs, bronze_path=scratch("bronze"), marts_path=scratch("marts"),
                          database="lm_lake", marts_database="lm_marts")
    out = run_lakehouse(spark, cfg)
    assert out["bronze_rows"] == table(spark, SF_SMALL, "orders").count()
    assert out["gate_rows"] > 0
    assert all(r[3] for r in out["expectations"])
    assert spark.table("lm_marts.mart_desigualdade").where(F.col("cor_raca") == "Não declarado").count() == 0


def test_bronze_audit_rides_on_write(spark, scratch):
    from lakemart.plans.exam.bronze import build_bronze
    inputs = write_exam_raw(exam_bronze_columns(table(spark, SF_SMALL, "orders")), scratch("raw"))
    out = build_bronze(spark, inputs, scratch("bronze"))
    assert out["rows"] == sum(out["rows_by_period"].values()) == 1500
    assert out["rows_by_period"] == {"2023": 925, "2024": 575}
    assert set(out["inconsistent"].values()) == {0}


def test_raw_inventory_folder_filter(spark, scratch):
    from lakemart.sources import raw_inventory
    root = scratch("zip") + "/dados/a+b"                       # the root itself holds a folder of that name
    for folder in ("DADOS/region", "LEIA-ME/region", "EXTRA/DADOS/region"):
        table(spark, SF_SMALL, "region").write.option("header", True).csv(f"{root}/ano=2023/{folder}")
    inv = raw_inventory(spark, root, folder="dados").collect()
    assert len(inv) >= 1 and all("/ano=2023/DADOS/" in r["path"] for r in inv)
    assert all(r["period"] == "2023" and r["name"] == r["name"].lower() for r in inv)
    assert {r["period"] for r in raw_inventory(spark, root, period_key="a.o").collect()} == {None}      # a key is no pattern
    with pytest.raises(FileNotFoundError):
        raw_inventory(spark, root, folder="none")
    assert raw_inventory(spark, root, folder="none", require=False).count() == 0


def test_dynamic_lakehouse_run_keeps_other_periods(spark, scratch, capsys):
    from lakemart.__main__ import main
    inputs = write_exam_raw(exam_bronze_columns(table(spark, SF_SMALL, "orders")), scratch("raw"))
    left, right = inputs.split["2024"]
    bronze, marts = scratch("bronze"), scratch("marts")
    single, split = ["--single", f"2023={inputs.single['2023']}"], ["--split", f"2024={left},{right}"]
    assert main(["lakehouse", *single, *split, "--bronze", bronze, "--marts", marts]) == 0
    assert main(["lakehouse", "--dynamic", *single, "--bronze", bronze, "--marts", marts]) == 0
    capsys.readouterr()
    rows = {r["ano"]: r["count"] for r in spark.read.parquet(bronze).groupBy("ano").count().collect()}
    assert {str(k): v for k, v in rows.items()} == {"2023": 925, "2024": 575}
    named = adhoc.income_by_sex(spark.table("default.exam_bronze"), ordered=False)             # reports name the table
    direct = adhoc.income_by_sex(exam_bronze(spark, SF_SMALL), ordered=False)
    assert sorted(map(str, named.collect())) == sorted(map(str, direct.collect()))
    assert spark.table("default_marts.mart_desigualdade").count() > 0
    with pytest.raises(DataQualityError, match="2025"):
        main(["lakehouse", "--single", f"2025={bronze}/none", "--bronze", bronze, "--marts", marts])


def test_overlapping_builds_keep_their_own_tables(spark):
    from lakemart.session import Scratch, materialize
    with Scratch(spark) as outer:
        first = materialize(spark.range(5), "outer", outer)
        with Scratch(spark) as inner:
            second = materialize(spark.range(7), "inner", inner)
            third = materialize(spark.range(9), "outer", outer)          # filed under the scope it names
            assert second.count() == 7
        assert first.count() == 5 and third.count() == 9


def test_command_line_bronze_and_reports(spark, scratch, capsys):
    import json
    from lakemart.__main__ import main
    inputs = write_exam_raw(exam_bronze_columns(table(spark, SF_SMALL, "orders")), scratch("raw"))
    bronze = scratch("bronze")
    left, right = inputs.split["2024"]
    assert main(["bronze", "--single", f"2023={inputs.single['2023']}", "--split", f"2024={left},{right}",
                 "--bronze", bronze]) == 0
    info = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert info["rows"] == 1500
    out = scratch("reports")
    assert main(["reports", "--bronze", bronze, "--out", out]) == 0
    back = spark.read.option("header", True).csv(f"{out}/mother_schooling")
    assert back.count() == 7


def test_bronze_build_drops_its_intermediate_tables(spark, scratch):
    import os
    from lakemart.plans.exam.bronze import build_bronze
    from lakemart.session import ensure_checkpoint_dir
    inputs = write_exam_raw(exam_bronze_columns(table(spark, SF_SMALL, "orders")), scratch("raw"))
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    scratch_dir = os.path.join(base, "lakemart-scratch")
    before = set(os.listdir(scratch_dir))
    out = scratch("bronze")
    build_bronze(spark, inputs, out)
    new = set(os.listdir(scratch_dir)) - before
    assert all(not n.startswith("indexed-rows") for n in new), new
    assert spark.read.parquet(out).count() == 1500
