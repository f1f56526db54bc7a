"""Data-quality checks: must-pass and must-fail rows with exact counts."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakemart.operators import (DataQualityError, check_expectations, grouped_report, ingest_summary,
                                gate_rows, missing_periods, reconcile,
                                reconcile_rules, require_files, require_rows)
from lakemart.functions import map_codes, n
from lakemart.sources import register_table
from lakemart.plans.exam import vocab as V
from lakemart.plans.exam.staging import stage_exam
from lakemart.plans.fixtures import exam_bronze, table

from conftest import SF_MID


def test_must_fail_rows(spark):
    rows = [(None, 2023, "Masculino"), (2, 2022, "Feminino"), (3, 2024, "Outro"), (4, 2024, None)]
    df = spark.createDataFrame(rows, "nu_inscricao long, ano int, sexo string")
    out = {(r["rule"], r["column"]): (r["failures"], r["passed"]) for r in
           check_expectations(df, not_null=["nu_inscricao", "sexo"],
                              accepted={"ano": [2023, 2024], "sexo": V.ACCEPTED_SEX}).collect()}
    assert out == {("not_null", "nu_inscricao"): (1, False), ("not_null", "sexo"): (1, False),
                   ("accepted_values", "ano"): (1, False), ("accepted_values", "sexo"): (1, False)}


def test_staging_passes_all_ten_rules(spark):
    st = stage_exam(exam_bronze(spark, SF_MID))
    res = check_expectations(st, not_null=V.STAGING_NOT_NULL,
                             accepted={"ano": [2023, 2024], "sexo": V.ACCEPTED_SEX}).collect()
    assert len(res) == 10 and all(r["passed"] for r in res)


def test_harness_exact_failure_counts(spark):
    orders = table(spark, SF_MID, "orders")
    r = check_expectations(orders, accepted={"o_orderstatus": ["F", "O"]}).first()
    assert r["failures"] == 5088
    r = check_expectations(exam_bronze(spark, SF_MID), not_null=["q007"]).first()
    assert r["failures"] == 307


def test_expectations_run_in_one_pass(spark):
    st = stage_exam(exam_bronze(spark, SF_MID))
    plan = check_expectations(st, not_null=V.STAGING_NOT_NULL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_empty_gate_raises(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(DataQualityError):
        gate_rows(empty, "mart")
    assert gate_rows(spark.range(3), "mart") == 3
    lazy = require_rows(empty, "mart")
    assert "LocalTableScan [table" not in lazy._jdf.queryExecution().executedPlan().toString()
    ok = require_rows(spark.createDataFrame([(1,)], "a int"), "mart").first()
    assert (ok["rows"], ok["passed"]) == (1, True)


def test_missing_period(spark, scratch):
    schema = StructType([StructField("k", LongType()), StructField("ano", StringType())])
    path = scratch("periods-present")
    spark.createDataFrame([(1, "2023"), (2, "2023")], schema).write.partitionBy("ano").parquet(path)
    register_table(spark, "lm_test_periods", path, schema, ["ano"])
    missing = missing_periods(spark, "lm_test_periods", "ano", ["2023", "2024"])
    assert [r[0] for r in missing.collect()] == ["2024"]
    assert "FileScan" not in missing._jdf.queryExecution().executedPlan().toString()     # the partition list only


def test_missing_input_files(spark, scratch):
    path = scratch("inputs")
    spark.range(2).write.parquet(f"{path}/a")
    require_files(spark, {"2023": [f"{path}/a"]})
    with pytest.raises(DataQualityError, match="2024"):
        require_files(spark, {"2023": [f"{path}/a"], "2024": [f"{path}/a", f"{path}/none"]})


def test_reconcile(spark):
    a = spark.range(3)
    b = spark.range(4)
    r = reconcile({"a": a, "b": b}, a.unionByName(b)).first()
    assert (r["parts_rows"], r["whole_rows"], r["balanced"]) == (7, 7, True)
    r = reconcile({"a": a}, b).first()
    assert r["balanced"] is False


def test_reconcile_rules_scan_once(spark, scratch):
    path = scratch("rules")
    spark.range(10).write.parquet(path)
    df = spark.read.parquet(path)
    out = reconcile_rules(df, {"low": F.col("id") < 4, "high": F.col("id") >= 4})
    assert tuple(out.first()) == (10, 10, True)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert tuple(reconcile_rules(df, {"low": F.col("id") < 4, "all": F.col("id") >= 0}).first()) == (14, 10, False)


def test_ingest_summary(spark):
    inv = spark.createDataFrame([("2023", "p/a.csv", "a.csv", 10), ("2023", "p/b.csv", "b.csv", 5)],
                                "period string, path string, name string, length long")
    got = {r["period"]: (r["files"], r["bytes"], r["status"]) for r in ingest_summary(inv, ["2023", "2024"]).collect()}
    assert got == {"2023": (2, 15, "present"), "2024": (0, 0, "missing"), "total": (2, 15, "1/2 present")}


def test_group_on_code_vs_label(spark):
    df = spark.createDataFrame([("X",), ("Y",), ("A",)], "c string")
    label = map_codes("c", {"A": "a"})
    by_code = grouped_report(df, ["c"], {"n": n()}, labels={"label": label}).collect()
    by_label = grouped_report(df, [label.alias("label")], {"n": n()}).collect()
    assert sorted((r["label"] or "", r["n"]) for r in by_code) == [("", 1), ("", 1), ("a", 1)]
    assert sorted((r["label"] or "", r["n"]) for r in by_label) == [("", 2), ("a", 1)]


def test_observed_counts_on_the_write_pass(spark, scratch):
    from lakemart.operators import observed
    df, obs = observed(spark.range(0, 1234), "rows")
    df.write.parquet(scratch("obs"))
    assert obs.get["rows"] == 1234


def test_gate_without_raising_and_empty_union(spark):
    from lakemart.operators import stack_periods
    r = require_rows(spark.createDataFrame([], "a int"), "mart").first()
    assert (r["table"], r["rows"], r["passed"]) == ("mart", 0, False)
    with pytest.raises(ValueError):
        stack_periods([])
