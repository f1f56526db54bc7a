"""Catalog registration and period-pruned scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemart.functions.sqlexpr import literal
from lakemart.sources.drift import require_no_drift


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_table(spark: SparkSession, name: str, path: str, schema: StructType,
                   partition_by: Sequence[str] = (), fmt: str = "parquet",
                   replace: bool = True, check: bool = False) -> DataFrame:
    """Declare an external table over ``path`` with a fixed schema and
    discover its partitions (S06).  The schema is declared, never re-inferred,
    so a partition column stays the declared type (e.g. a string period).

    With ``replace=False`` an existing table is kept and only its partitions
    are rediscovered — what a re-run after a new period landed needs.  ``check``
    compares every Parquet footer with ``schema`` first and raises
    :class:`~lakemart.sources.drift.SchemaDrift`, naming the period, before the
    catalog is touched.
    """
    if check:
        require_no_drift(spark, path, schema, partition_by)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    if replace or not spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({_ddl(schema)}) USING {fmt}{parts} LOCATION {literal(path)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def scan_periods(spark: SparkSession, table: str, periods: Sequence, key: str = "ano") -> DataFrame:
    """Rows of the given periods only; the predicate becomes a partition
    filter, so other periods' files are never listed or opened (S07, F01, F02)."""
    t = spark.table(table)
    vals = [str(p) for p in periods]
    return t.where(F.col(key) == vals[0]) if len(vals) == 1 else t.where(F.col(key).isin(vals))


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A view of this session only: the plan is inlined into each reader."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """A persistent view in the catalog (S08): its text is stored, so every session that sees the catalog can
    read it by name, and it follows the tables below.  ``name`` is ``schema.view``; the text must name catalog tables only
    (Spark refuses temporary ones)."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def as_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
             fmt: str = "parquet") -> DataFrame:
    """Materialize as a table (S09); ``path`` makes it external (shared storage)."""
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)
