"""Data-quality bindings (D01–D05, D07; D06 lives with the exam table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.harness.common import ORDER_COLS, exam_bronze, orders_with_year, staging, table
from lakemart.harness.q_sources import ORDERS_BY_YEAR, _orders_bronze
from lakemart.harness.registry import register
from lakemart.harness.sqltext import MART_STATE_SQL, with_stg, with_xb
from lakemart.operators.quality import (check_expectations, ingest_summary, missing_periods,
                                        reconcile, reconcile_rules, require_rows)
from lakemart.plans.exam import vocab as V
from lakemart.plans.exam.marts import mart_state
from lakemart.session import scratch_path
from lakemart.sources.catalog import register_table
from lakemart.sources.files import raw_inventory, write_csv

XB_NOT_NULL = ["nu_inscricao", "q007", "tp_escola", "tp_dependencia_adm_esc"]


@register("d01_not_null", with_xb("\nUNION ALL\n".join(
    f"SELECT 'not_null' AS rule, '{c}' AS \"column\", "
    f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::BIGINT AS failures, "
    f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = 0 AS passed FROM xb" for c in XB_NOT_NULL)))
def d01(spark, sf_dir):
    return check_expectations(exam_bronze(spark, sf_dir), not_null=XB_NOT_NULL)


@register("d01_staging_expectations", with_stg("\nUNION ALL\n".join(
    [f"SELECT 'not_null' AS rule, '{c}' AS \"column\", "
     f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::BIGINT AS failures, "
     f"SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) = 0 AS passed FROM stg" for c in V.STAGING_NOT_NULL]
    + ["SELECT 'accepted_values' AS rule, 'ano' AS \"column\", "
       "SUM(CASE WHEN ano IS NOT NULL AND ano NOT IN (2023, 2024) THEN 1 ELSE 0 END)::BIGINT AS failures, "
       "SUM(CASE WHEN ano IS NOT NULL AND ano NOT IN (2023, 2024) THEN 1 ELSE 0 END) = 0 AS passed FROM stg",
       "SELECT 'accepted_values' AS rule, 'sexo' AS \"column\", "
       "SUM(CASE WHEN sexo IS NOT NULL AND sexo NOT IN ('Masculino', 'Feminino') THEN 1 ELSE 0 END)::BIGINT"
       " AS failures, "
       "SUM(CASE WHEN sexo IS NOT NULL AND sexo NOT IN ('Masculino', 'Feminino') THEN 1 ELSE 0 END) = 0"
       " AS passed FROM stg"])))
def d01_staging(spark, sf_dir):
    return check_expectations(staging(spark, sf_dir), not_null=V.STAGING_NOT_NULL,
                              accepted={"ano": [2023, 2024], "sexo": V.ACCEPTED_SEX})


@register("d02_accepted_values", """
SELECT 'accepted_values' AS rule, 'o_orderstatus' AS "column",
       SUM(CASE WHEN o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') THEN 1 ELSE 0 END)::BIGINT
         AS failures,
       SUM(CASE WHEN o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') THEN 1 ELSE 0 END) = 0
         AS passed
FROM orders
""")
def d02(spark, sf_dir):
    return check_expectations(table(spark, sf_dir, "orders"), accepted={"o_orderstatus": ["F", "O"]})


@register("d03_non_empty_gate", with_stg(f"""
SELECT 'mart_state' AS "table", COUNT(*) AS rows, COUNT(*) > 0 AS passed FROM ({MART_STATE_SQL}) m
"""))
def d03(spark, sf_dir):
    return require_rows(mart_state(staging(spark, sf_dir), ordered=False), "mart_state")


EXPECTED_YEARS = [str(y) for y in range(1994, 2003)]


@register("d04_missing_periods", f"""
SELECT ano FROM (VALUES {', '.join(f"('{y}')" for y in EXPECTED_YEARS)}) AS expected(ano)
WHERE ano NOT IN (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) FROM orders)
""")
def d04(spark, sf_dir):
    register_table(spark, "lm_d04_orders", _orders_bronze(spark, sf_dir), ORDERS_BY_YEAR, ["ano"])
    return missing_periods(spark, "lm_d04_orders", "ano", EXPECTED_YEARS)


@register("d05_row_reconciliation", """
SELECT COUNT(*) AS parts_rows, COUNT(*) AS whole_rows, true AS balanced FROM orders
""")
def d05(spark, sf_dir):
    o = orders_with_year(spark, sf_dir)
    parts = {"early": o.where(F.col("ano") <= "1998"), "late": o.where(F.col("ano") > "1998")}
    whole = spark.read.schema(ORDERS_BY_YEAR).parquet(_orders_bronze(spark, sf_dir))
    return reconcile(parts, whole)


@register("d05_reconcile_rules", """
SELECT COUNT(*) AS parts_rows, COUNT(*) AS whole_rows, true AS balanced FROM orders
""")
def d05_rules(spark, sf_dir):
    stored = spark.read.schema(ORDERS_BY_YEAR).parquet(_orders_bronze(spark, sf_dir))
    return reconcile_rules(stored, {"early": F.col("ano") <= "1998", "late": F.col("ano") > "1998"})


@register("d07_ingest_summary", """
WITH per AS (
  SELECT '2023' AS period, count(*) > 0 AS present FROM orders
  UNION ALL SELECT '2024', count(*) > 0 FROM lineitem
  UNION ALL SELECT '2025', false)
SELECT period, present, CASE WHEN present THEN 'present' ELSE 'missing' END AS status FROM per
UNION ALL SELECT 'total', true, count(*) FILTER (WHERE present) || '/' || count(*) || ' present' FROM per
""")
def d07(spark, sf_dir):
    root = scratch_path(spark, "raw_zone")
    write_csv(table(spark, sf_dir, "orders").select(*ORDER_COLS), f"{root}/ano=2023/orders")
    write_csv(table(spark, sf_dir, "lineitem"), f"{root}/ano=2024/lineitem")
    summary = ingest_summary(raw_inventory(spark, root), ["2023", "2024", "2025"])
    return summary.select("period", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("present"), "status")


@register("d04_missing_period_files", f"""
SELECT ano FROM (VALUES {', '.join(f"('{y}')" for y in EXPECTED_YEARS)}) AS expected(ano)
WHERE ano NOT IN (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) FROM orders)
""")
def d04_files(spark, sf_dir):
    from lakemart.operators.quality import missing_period_files
    return missing_period_files(spark, _orders_bronze(spark, sf_dir), EXPECTED_YEARS)
