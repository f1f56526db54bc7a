"""Plan shape: pruning, pushdown, partition filters, one aggregation pass."""

from pyspark.sql import functions as F

from lakemart.plans.exam.bronze import read_bronze
from lakemart.plans.exam.marts import mart_state
from lakemart.plans.exam.staging import stage_exam
from lakemart.plans.fixtures import exam_bronze
from lakemart.sources import register_table, scan_periods, write_partitioned

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_bronze_scan_prunes_and_filters(spark, scratch):
    path = scratch("bronze")
    write_partitioned(exam_bronze(spark, SF_SMALL), path, "ano")
    bronze = read_bronze(spark, path)
    assert dict((f.name, f.dataType.simpleString()) for f in bronze.schema.fields)["ano"] == "string"
    mart = mart_state(stage_exam(bronze.where(F.col("ano") == "2024")), ordered=False)
    text = formatted(mart)
    assert "PartitionFilters: [isnotnull(ano" in text and "2024" in text
    pushed = [l for l in text.splitlines() if l.startswith("PushedFilters")][0]
    assert "EqualTo(tp_presenca_mt,1)" in pushed and "GreaterThan(nu_nota_redacao,0.0)" in pushed
    read_schema = [l for l in text.splitlines() if l.startswith("ReadSchema")][0]
    assert "tx_respostas_cn" not in read_schema and "nu_nota_mt" in read_schema
    assert read_schema.count(":") < 20
    assert plan(mart).count("HashAggregate") == 2          # partial + final, one exchange


def test_staging_view_filter_reaches_partitions(spark, scratch):
    path = scratch("bronze")
    write_partitioned(exam_bronze(spark, SF_SMALL), path, "ano")
    mart = mart_state(stage_exam(read_bronze(spark, path)).where(F.col("ano") == 2023), ordered=False)
    assert "PartitionFilters: [isnotnull(ano" in formatted(mart)


def test_catalog_scan_prunes_partitions(spark, scratch):
    from lakemart.plans.exam.bronze import BRONZE_SCHEMA
    path = scratch("bronze")
    write_partitioned(exam_bronze(spark, SF_SMALL), path, "ano")
    register_table(spark, "lm_test_bronze", path, BRONZE_SCHEMA, ["ano"])
    df = scan_periods(spark, "lm_test_bronze", ["2024"])
    assert "PartitionFilters" in formatted(df)
    assert df.count() == exam_bronze(spark, SF_SMALL).where(F.col("ano") == "2024").count()


def test_staging_runs_in_whole_stage_codegen(spark):
    text = formatted(stage_exam(exam_bronze(spark, SF_SMALL)))
    projects = [l for l in text.splitlines() if l.startswith("(") and " Project " in l]
    assert projects and all("[codegen id" in l for l in projects)


def test_register_table_rediscovers_new_period(spark, scratch):
    from pyspark.sql.types import StringType, StructField, StructType, LongType
    schema = StructType([StructField("k", LongType()), StructField("ano", StringType())])
    path = scratch("periods")
    spark.createDataFrame([(1, "2023")], schema).write.partitionBy("ano").parquet(path)
    register_table(spark, "lm_periods", path, schema, ["ano"])
    assert [r[0] for r in spark.sql("SELECT DISTINCT ano FROM lm_periods").collect()] == ["2023"]
    spark.createDataFrame([(2, "2024")], schema).write.mode("append").partitionBy("ano").parquet(path)
    register_table(spark, "lm_periods", path, schema, ["ano"], replace=False)
    assert sorted(r[0] for r in spark.sql("SELECT DISTINCT ano FROM lm_periods").collect()) == ["2023", "2024"]


def test_staging_method_fits_the_jit_limit(spark, scratch):
    """HotSpot skips JIT compilation of methods above 8000 bytes of bytecode;
    the fused staging stage over bronze must stay below it."""
    path = scratch("bronze")
    write_partitioned(exam_bronze(spark, SF_SMALL), path, "ano")
    df = stage_exam(read_bronze(spark, path))
    seq = df._jdf.queryExecution().debug().codegenToSeq()
    sizes = [seq.apply(i)._3().maxMethodCodeSize() for i in range(seq.size())]
    assert sizes and max(sizes) < 8000, sizes
