"""Schema conformance, overlap handling, union, ordering."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lakemart.operators import (SchemaError, conform, drop_overlap, lower_names, rename, stack_periods,
                                top_k, with_position)

TARGET = StructType([StructField("id", LongType()), StructField("grade", DoubleType()),
                     StructField("missing", StringType())])


def test_lower_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "A int, B int")
    assert lower_names(df).columns == ["a", "b"]
    with pytest.raises(SchemaError):
        lower_names(spark.createDataFrame([(1, 2)], "A int, b int").toDF("A", "a"))


def test_conform_missing_extra_permuted(spark):
    df = spark.createDataFrame([("1.5", "3", "junk")], "grade string, id string, extra string")
    out = conform(df, TARGET)
    assert out.columns == ["id", "grade", "missing"]
    assert [f.dataType for f in out.schema.fields] == [LongType(), DoubleType(), StringType()]
    assert tuple(out.first()) == (3, 1.5, None)


def test_conform_dirty_values_become_null(spark):
    df = spark.createDataFrame([("abc", "")], "id string, grade string")
    assert tuple(conform(df, TARGET).first()) == (None, None, None)


def test_drop_overlap(spark):
    left = spark.createDataFrame([(1, "x")], "k int, a string")
    right = spark.createDataFrame([(1, "y", 2)], "k int, a string, b int")
    assert drop_overlap(left, right, expected=["k", "a"]).columns == ["b"]
    assert drop_overlap(left, right, keep=["k"]).columns == ["k", "b"]
    with pytest.raises(SchemaError):
        drop_overlap(left, right, expected=["k"])


def test_rename_unknown_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rename(df, {"a": "b"}).columns == ["b"]
    with pytest.raises(SchemaError):
        rename(df, {"zz": "b"})


def test_stack_periods_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert sorted(tuple(r) for r in stack_periods([a, b]).collect()) == [(1, "x"), (2, "y")]


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 5.0), (4, 7.0), (5, 1.0)], "id int, v double")
    got = [tuple(r) for r in top_k(df, "v", 3, tie_break=["id"], cols=["id", "v"]).collect()]
    assert got == [(4, 7.0), (1, 5.0), (3, 5.0)]
    plan = top_k(df, "v", 3, tie_break=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_with_position_is_global(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"))
    out = with_position(df.repartition(7), ["k"])
    rows = {r["k"]: r["pos"] for r in out.collect()}
    assert all(rows[k] == k + 1 for k in range(500))


def test_read_period_addresses_year_directory(spark, scratch):
    from lakemart.sources import period_path, read_period
    root = scratch("periods")
    for y in ("2023", "2024"):
        spark.createDataFrame([(y, "São Paulo")], "k string, city string").write \
            .option("header", True).option("sep", ";").option("encoding", "ISO-8859-1") \
            .csv(period_path(root, y, "part"))
    got = read_period(spark, root, "2024", "part").collect()
    assert [tuple(r) for r in got] == [("2024", "São Paulo")]


def test_static_vs_dynamic_period_overwrite(spark, scratch):
    from lakemart.sources import write_partitioned
    path = scratch("overwrite")
    both = spark.createDataFrame([(1, "2023"), (2, "2024")], "k int, ano string")
    write_partitioned(both, path, "ano")
    write_partitioned(spark.createDataFrame([(3, "2024")], "k int, ano string"), path, "ano", dynamic=True)
    read = lambda: sorted(tuple(r) for r in spark.read.schema("k int, ano string").parquet(path).collect())
    assert read() == [(1, "2023"), (3, "2024")]          # one period reloaded in place
    write_partitioned(spark.createDataFrame([(4, "2024")], "k int, ano string"), path, "ano")
    assert read() == [(4, "2024")]                       # static overwrite replaces every period


def test_conform_keeps_listed_extras_and_casts_typed_sources(spark):
    df = spark.createDataFrame([(2.9, 7, "x", "keep me")], "grade_d double, id int, missing string, note string")
    out = conform(df.withColumnRenamed("grade_d", "grade"), TARGET, keep=["note"])
    assert out.columns == ["id", "grade", "missing", "note"]
    assert [f.dataType for f in out.schema.fields][:2] == [LongType(), DoubleType()]
    assert tuple(out.first()) == (7, 2.9, "x", "keep me")


def test_extend_and_pick_are_single_projections(spark):
    from lakemart.operators import extend, pick
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = pick(extend(df, c=F.col("a") + F.col("b")), ["c", "a"])
    assert out.columns == ["c", "a"] and tuple(out.first()) == (3, 1)
