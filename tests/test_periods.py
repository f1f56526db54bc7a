"""Period by period: a release that fails is reported, the others are published."""

import csv
import glob
import json

from lakemart.__main__ import main
from lakemart.operators import ingest_summary
from lakemart.plans.exam.bronze import BRONZE_SCHEMA, build_bronze, build_periods, read_bronze
from lakemart.plans.fixtures import exam_bronze_columns, table, write_exam_raw
from lakemart.sources import register_table

from conftest import SF_SMALL


def raw(spark, scratch):
    return write_exam_raw(exam_bronze_columns(table(spark, SF_SMALL, "orders")), scratch("raw"))


def by_period(spark, path):
    return {r["ano"]: r["count"] for r in read_bronze(spark, path).groupBy("ano").count().collect()}


def test_a_failed_period_is_reported_and_keeps_its_partition(spark, scratch, capsys):
    inputs, out = raw(spark, scratch), scratch("bronze")
    build_bronze(spark, inputs, out)
    before = by_period(spark, out)
    left, right = inputs.split["2024"]
    good, inputs.split["2024"] = inputs.split["2024"], (left, inputs.single["2023"])       # parts that do not belong together
    inputs.single["2022"] = scratch("nothing-here")
    got = build_periods(spark, inputs, out)
    assert [(d["period"], d["status"]) for d in got["periods"]] == [("2022", "failed"), ("2023", "published"), ("2024", "failed")]
    assert got["rows"] == before["2023"] and set(got["failures"]) == {"2022", "2024"} and all(got["failures"].values())
    assert by_period(spark, out) == before

    args = ["bronze", "--keep-going", "--bronze", out, "--single", f"2023={inputs.single['2023']}", "--split"]
    assert main([*args, f"2024={left},{inputs.single['2023']}"]) == 1
    assert list(json.loads(capsys.readouterr().out.strip().splitlines()[-1])["failures"]) == ["2024"]
    assert main([*args, f"2024={good[0]},{good[1]}"]) == 0
    assert by_period(spark, out) == before


def test_an_audit_fails_one_period_only(spark, scratch):
    inputs, out = raw(spark, scratch), scratch("bronze")

    def audit(info):
        if "2024" in info["rows_by_period"]:
            raise ValueError("not this one\nsecond line")

    got = build_periods(spark, inputs, out, audit=audit)
    assert got["failures"] == {"2024": "ValueError: not this one"} and set(by_period(spark, out)) == {"2023"}


def test_ingest_summary_with_failures(spark):
    inventory = spark.createDataFrame([("2022", "a", "a.csv", 5), ("2023", "b", "b.csv", 7)], "period string, path string, name string, length long")
    rows = ingest_summary(inventory, [2022, 2023, 2024], failures={2023: "bad header"}).collect()
    got = {r["period"]: (r["files"], r["status"], r["error"]) for r in rows}
    assert got == {"2022": (1, "present", None), "2023": (1, "failed", "bad header"), "2024": (0, "missing", None),
                   "total": (2, "1/3 present", None)}
    assert ingest_summary(inventory, [2022]).columns == ["period", "files", "bytes", "status"]
    assert ingest_summary(inventory, [2022], failures={}).columns == ["period", "files", "bytes", "status", "error"]


def test_reports_by_table_name_equal_those_by_path(spark, scratch, capsys):
    inputs, out = raw(spark, scratch), scratch("bronze")
    build_bronze(spark, inputs, out)
    spark.sql("CREATE DATABASE IF NOT EXISTS periods_db")
    register_table(spark, "periods_db.exam", out, BRONZE_SCHEMA, ["ano"])
    read = lambda d: {n: sorted(map(tuple, (r for f in glob.glob(f"{d.removeprefix('file:')}/{n}/*.csv") for r in csv.reader(open(f)))))
                      for n in ("income_by_sex", "race_by_year", "mother_schooling", "income_band_by_school")}
    a, b = scratch("a"), scratch("b")
    assert main(["reports", "--bronze", out, "--out", a]) == main(["reports", "--table", "periods_db.exam", "--out", b]) == 0
    assert read(a) == read(b) and all(len(x) > 1 for x in read(a).values())
    spark.sql("DROP TABLE periods_db.exam")
