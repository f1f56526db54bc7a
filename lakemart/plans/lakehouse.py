"""One Spark application for the whole lakehouse run: period files present →
bronze (published after its audit) → catalog → staging view → expectations → mart tables →
non-empty gate.

The stages are called in plain order (no scheduler); each stage is a lazy
plan executed by its own write.  Every mart reads the columns it needs from
bronze again: three pruned Parquet scans cost less than caching 23 columns
on executor disks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from lakemart.operators.quality import DataQualityError, check_expectations, gate_rows, require_files
from lakemart.plans.exam import vocab as V
from lakemart.plans.exam.bronze import BRONZE_SCHEMA, BronzeInputs, build_bronze
from lakemart.plans.exam.marts import mart_inequality, mart_mobility, mart_state
from lakemart.plans.exam.staging import staging_sql
from lakemart.sources.catalog import as_table, create_view, register_table


@dataclass
class LakehouseConfig:
    """``database`` holds bronze; the staging view goes to ``staging_database`` (default ``<database>_staging``), the marts to
    ``marts_database`` (default ``<database>_marts``).  ``dynamic``: replace only the periods given, keep the others."""
    inputs: BronzeInputs
    bronze_path: str
    marts_path: str
    database: str = "default"
    staging_database: str | None = None
    marts_database: str | None = None
    bronze_table: str = "exam_bronze"
    staging_view: str = "stg_exam"
    dynamic: bool = False
    gate_table: str = "mart_desempenho_por_estado"
    marts: dict = field(default_factory=lambda: {
        "mart_desempenho_por_estado": mart_state,
        "mart_desigualdade": mart_inequality,
        "mart_mobilidade_educacional": mart_mobility,
    })


def run_lakehouse(spark: SparkSession, cfg: LakehouseConfig) -> dict:
    """Run every stage; return counts and the expectation results.

    Raises :class:`DataQualityError` when a period has no raw file, the
    positional audit or the reconciliation finds a row, an expectation fails
    or the gate table is empty.
    """
    marts_db = cfg.marts_database or f"{cfg.database}_marts"
    periods = sorted(set(cfg.inputs.single) | set(cfg.inputs.split))
    require_files(spark, {p: [cfg.inputs.single[p]] if p in cfg.inputs.single else list(cfg.inputs.split[p]) for p in periods})
    info = build_bronze(spark, cfg.inputs, cfg.bronze_path, dynamic=cfg.dynamic)
    staging_db = cfg.staging_database or f"{cfg.database}_staging"
    for db in (cfg.database, staging_db, marts_db):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    register_table(spark, f"{cfg.database}.{cfg.bronze_table}", cfg.bronze_path, BRONZE_SCHEMA, ["ano"])
    staging = create_view(spark, f"{staging_db}.{cfg.staging_view}", staging_sql(f"{cfg.database}.{cfg.bronze_table}"))
    known = [r[0] for r in spark.sql(f"SHOW PARTITIONS {cfg.database}.{cfg.bronze_table}")
             .selectExpr("try_cast(split(partition, '=')[1] AS INT)").collect() if r[0] is not None]      # the null partition has no year
    checks = check_expectations(staging, not_null=V.STAGING_NOT_NULL,
                                accepted={"ano": sorted({*known, *map(int, periods)}), "sexo": V.ACCEPTED_SEX}).collect()
    failed = [(r["rule"], r["column"], r["failures"]) for r in checks if not r["passed"]]
    if failed:
        raise DataQualityError(f"expectations failed: {failed}")
    tables = {}
    for name, build in cfg.marts.items():
        tables[name] = as_table(build(staging, ordered=False), f"{marts_db}.{name}",
                                path=f"{cfg.marts_path.rstrip('/')}/{name}")
    rows = gate_rows(tables[cfg.gate_table], cfg.gate_table)
    return {"bronze_rows": info["rows"], "rows_by_period": info["rows_by_period"], "inconsistent": info["inconsistent"],
            "gate_rows": rows, "expectations": [tuple(r) for r in checks],
            "bronze_table": f"{cfg.database}.{cfg.bronze_table}", "staging_view": f"{staging_db}.{cfg.staging_view}", "marts": [f"{marts_db}.{t}" for t in tables]}
