"""Helpers shared by the harness bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from lakemart.plans.fixtures import exam_bronze, table  # noqa: F401  (re-exported)
from lakemart.plans.exam.staging import stage_exam

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def orders_with_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(*ORDER_COLS, F.year("o_orderdate").cast(StringType()).alias("ano"))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_exam(exam_bronze(spark, sf_dir))
