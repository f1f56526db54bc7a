"""Data-quality checks and gates.

Column expectations run as ONE aggregation pass over the table, however
many rules there are: each rule is a ``count_if`` over the same scan, and
the single result row is unpivoted into ``(rule, column, failures)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType


class DataQualityError(RuntimeError):
    """A gate failed (empty table, missing partition, unbalanced counts)."""


def _fail_count(pred) -> Column:
    return F.sum(F.when(pred, 1).otherwise(0)).cast(LongType())


def check_expectations(df: DataFrame, not_null: Iterable[str] = (),
                       accepted: Mapping[str, Sequence] | None = None) -> DataFrame:
    """``not_null`` and ``accepted_values`` rules in one pass.

    Returns ``(rule string, column string, failures bigint, passed boolean)``,
    one row per rule.  For accepted values a NULL is not a violation.
    """
    rules = [("not_null", c, F.col(c).isNull()) for c in not_null]
    rules += [("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(list(vals)))
              for c, vals in (accepted or {}).items()]
    if not rules:
        raise ValueError("no rules given")
    row = df.agg(*[_fail_count(p).alias(f"r{i}") for i, (_, _, p) in enumerate(rules)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(f"r{i}").alias("failures"))
        for i, (r, c, _) in enumerate(rules)]))
    return (row.select(stacked.alias("x"))
            .select("x.rule", "x.column", "x.failures", (F.col("x.failures") == 0).alias("passed")))


def check_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return check_expectations(df, not_null=cols)


def check_accepted(df: DataFrame, accepted: Mapping[str, Sequence]) -> DataFrame:
    return check_expectations(df, accepted=accepted)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Non-empty check, lazily: one row ``(table, rows, passed)``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows", (F.col("rows") > 0).alias("passed"))


def gate_rows(df: DataFrame, name: str) -> int:
    """The gate itself: run the check now, raise when the table is empty, else return its rows."""
    rows = require_rows(df, name).first()["rows"]
    if not rows:
        raise DataQualityError(f"{name} is empty")
    return rows


def missing_periods(spark: SparkSession, table: str, period_col: str, expected: Sequence) -> DataFrame:
    """Expected periods that are no partition of a catalog table (empty result = complete).

    Reads the catalog's partition list only: no data file is opened, whatever the table holds.
    """
    present = (spark.sql(f"SHOW PARTITIONS {table}")
               .select(F.explode(F.split("partition", "/")).alias("p"))
               .where(F.col("p").startswith(f"{period_col}="))
               .select(F.substring_index("p", "=", -1).alias(period_col)))
    want = spark.createDataFrame([(str(v),) for v in expected], StructType([StructField(period_col, StringType())]))
    return want.join(present, period_col, "left_anti")


def require_files(spark: SparkSession, paths: Mapping[str, Sequence[str]]) -> None:
    """Gate before a build: every period's input paths must exist and hold a file; raises naming the periods that lack one."""
    fs = spark._jvm.org.apache.hadoop.fs.Path
    hadoop = spark._jsc.hadoopConfiguration()

    def present(path: str) -> bool:
        p = fs(path)
        found = p.getFileSystem(hadoop).globStatus(p)
        return any(s.isFile() or p.getFileSystem(hadoop).listStatus(s.getPath()) for s in found or ())

    missing = {period: [x for x in files if not present(x)] for period, files in paths.items()}
    missing = {k: v for k, v in missing.items() if v}
    if missing:
        raise DataQualityError(f"no input for periods: {missing}")


def missing_period_files(spark: SparkSession, root: str, expected: Sequence, key: str = "ano",
                         suffix: str = ".parquet") -> DataFrame:
    """Expected periods with no ``{key}=<period>/*{suffix}`` file under ``root``.

    Works on the file listing only (no data file is opened), like a storage
    sensor: at least one data file must exist per expected period.
    """
    from lakemart.sources.files import raw_inventory
    present = (raw_inventory(spark, root, suffix=suffix, period_key=key, require=False)
               .select(F.col("period").alias(key)).distinct())
    want = spark.createDataFrame([(str(v),) for v in expected], StructType([StructField(key, StringType())]))
    return want.join(present, key, "left_anti")


def reconcile(parts: Mapping[str, DataFrame], whole: DataFrame) -> DataFrame:
    """Do the part row counts add up to the whole?  One row: ``(parts_rows, whole_rows, balanced)``."""
    tagged = [p.select(F.lit("part").alias("side")) for p in parts.values()] + [whole.select(F.lit("whole").alias("side"))]
    return _balance(reduce(DataFrame.union, tagged), F.col("side") == "part", F.col("side") == "whole")


def reconcile_rules(df: DataFrame, parts: Mapping[str, Column]) -> DataFrame:
    """The same when the parts are conditions on one table: a single scan counts the rows that
    the parts claim (a row claimed twice counts twice) and all rows."""
    claimed = reduce(lambda a, b: a + b, [F.when(c, 1).otherwise(0) for c in parts.values()])
    agg = df.agg(F.sum(claimed).cast(LongType()).alias("parts_rows"), F.count(F.lit(1)).alias("whole_rows"))
    return agg.select(F.coalesce("parts_rows", F.lit(0)).alias("parts_rows"), "whole_rows",
                      (F.coalesce("parts_rows", F.lit(0)) == F.col("whole_rows")).alias("balanced"))


def _balance(rows: DataFrame, part: Column, whole: Column) -> DataFrame:
    agg = rows.agg(F.coalesce(_fail_count(part), F.lit(0)).alias("parts_rows"), F.coalesce(_fail_count(whole), F.lit(0)).alias("whole_rows"))
    return agg.withColumn("balanced", F.col("parts_rows") == F.col("whole_rows"))


def ingest_summary(inventory: DataFrame, expected: Sequence, period_col: str = "period",
                   with_total: bool = True, failures: Mapping | None = None) -> DataFrame:
    """Per expected period: files, bytes and status present/missing.

    ``inventory`` is the output of ``raw_inventory`` (period, path, name,
    length).  With ``with_total`` a last row (period ``total``) sums files and
    bytes and reports ``<present>/<expected> present``.  With ``failures`` (period -> error of its
    processing, empty if all went well) such a period has status failed, whatever files it has, and a column ``error``
    holds the text.
    """
    spark: SparkSession = inventory.sparkSession
    errors = {str(k): str(v) for k, v in (failures or {}).items()}
    want = spark.createDataFrame([(str(v), errors.get(str(v))) for v in expected],
                                 StructType([StructField(period_col, StringType()), StructField("error", StringType())]))
    per = (inventory.groupBy(period_col)
           .agg(F.count(F.lit(1)).alias("files"), F.sum("length").cast(LongType()).alias("bytes")))
    out = want.join(per, period_col, "left").select(
        period_col,
        F.coalesce("files", F.lit(0)).cast(LongType()).alias("files"),
        F.coalesce("bytes", F.lit(0)).cast(LongType()).alias("bytes"),
        F.when(F.col("error").isNotNull(), F.lit("failed")).when(F.col("files") > 0, F.lit("present"))
        .otherwise(F.lit("missing")).alias("status"), *(["error"] if failures is not None else []))
    if not with_total:
        return out
    total = out.agg(
        F.lit("total").alias(period_col),
        F.sum("files").cast(LongType()).alias("files"),
        F.sum("bytes").cast(LongType()).alias("bytes"),
        F.format_string("%d/%d present", F.sum(F.when(F.col("status") == "present", 1).otherwise(0)),
                        F.count(F.lit(1))).alias("status"))
    return out.unionByName(total, allowMissingColumns=True)
