"""Positional alignment must equal a keyed join for any split layout."""

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakemart.operators import PositionalMismatch, ordinal_index, pinned_index, positional_audit, zip_by_position
from lakemart.sources import read_delimited


class small_splits:
    """Force many input splits (and restore the session afterwards)."""

    def __init__(self, spark, max_bytes=2048):
        self.spark, self.max_bytes = spark, max_bytes

    def __enter__(self):
        c = self.spark.conf
        self.old = (c.get("spark.sql.files.maxPartitionBytes"), c.get("spark.sql.files.openCostInBytes"))
        c.set("spark.sql.files.maxPartitionBytes", str(self.max_bytes))
        c.set("spark.sql.files.openCostInBytes", "512")

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.files.maxPartitionBytes", self.old[0])
        self.spark.conf.set("spark.sql.files.openCostInBytes", self.old[1])


def write_sides(spark, root, n, left_files, right_files, pad):
    base = spark.range(0, n).withColumnRenamed("id", "k")
    (base.repartitionByRange(left_files, "k").sortWithinPartitions("k")
     .select("k", (F.col("k") * 3).alias("a"))
     .write.option("header", True).option("sep", ";").csv(f"{root}/left"))
    (base.repartitionByRange(right_files, "k").sortWithinPartitions("k")
     .select((F.col("k") * 3).alias("a"), (F.col("k") + 1000).alias("b"),
             F.repeat(F.lit("x"), ((F.col("k") * 7) % pad).cast("int")).alias("pad"))
     .write.option("header", True).option("sep", ";").csv(f"{root}/right"))


def check_alignment(spark, root, n):
    left = read_delimited(spark, f"{root}/left", encoding="UTF-8")
    right = read_delimited(spark, f"{root}/right", encoding="UTF-8")
    out = zip_by_position(left, right, expected_overlap=["a"])
    rows = out.select(F.col("k").cast("long"), F.col("a").cast("long"), F.col("b").cast("long")).collect()
    assert len(rows) == n
    assert all(r[1] == 3 * r[0] and r[2] == r[0] + 1000 for r in rows)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(min_value=1, max_value=3000), lf=st.integers(1, 4), rf=st.integers(1, 6),
       pad=st.integers(1, 60))
def test_zip_equals_keyed_join_many_splits(spark, scratch, n, lf, rf, pad):
    root = scratch("j01prop")
    write_sides(spark, root, n, lf, rf, pad)
    with small_splits(spark):
        check_alignment(spark, root, n)


def test_ordinal_is_dense_across_splits(spark, scratch):
    root = scratch("ordinal")
    spark.range(0, 5000).select(F.col("id").alias("k"), F.repeat(F.lit("z"), (F.col("id") % 31).cast("int")).alias("p")) \
        .coalesce(1).write.option("header", True).csv(root)
    with small_splits(spark, 4096):
        df = spark.read.option("header", True).csv(root)
        assert df.rdd.getNumPartitions() > 4
        side = ordinal_index(df)
        rows = side.rows
        assert side.splits > 4
        got = side.df.select(F.col("k").cast("long"), "_idx").collect()
    assert rows == 5000
    assert all(r[0] == r[1] for r in got)


def test_gzip_is_one_block(spark, scratch):
    root = scratch("gz")
    spark.range(0, 2000).withColumnRenamed("id", "k").coalesce(1).write \
        .option("header", True).option("compression", "gzip").csv(root)
    with small_splits(spark):
        side = ordinal_index(spark.read.option("header", True).csv(root))
        rows, got = side.rows, side.df.collect()
    assert rows == 2000
    assert all(int(r[0]) == r[1] for r in got)


def test_unequal_counts_raise(spark, scratch):
    root = scratch("uneq")
    spark.range(0, 10).write.option("header", True).csv(f"{root}/l")
    spark.range(0, 11).select(F.col("id").alias("x")).write.option("header", True).csv(f"{root}/r")
    with pytest.raises(PositionalMismatch):
        zip_by_position(spark.read.option("header", True).csv(f"{root}/l"),
                        spark.read.option("header", True).csv(f"{root}/r"))


def test_ordinal_survives_layout_change(spark, scratch):
    """Tags are stored on the first pass: re-planning under another split
    size (as after losing executors) must not change any ordinal."""
    root = scratch("layout")
    spark.range(0, 3000).select(F.col("id").alias("k"), F.repeat(F.lit("q"), 20).alias("p")) \
        .coalesce(1).write.option("header", True).csv(root)
    with small_splits(spark, 4096):
        idx = ordinal_index(spark.read.option("header", True).csv(root)).df
    got = idx.select(F.col("k").cast("long"), "_idx").collect()
    assert len(got) == 3000 and all(r[0] == r[1] for r in got)


def test_positional_audit(spark):
    df = spark.createDataFrame([(1, 500.0), (0, None), (0, 10.0), (2, None)], "pres long, grade double")
    r = positional_audit(df, {"pres": "grade"}).first()
    assert (r["rows"], r["grade_inconsistent"]) == (4, 1)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_split_table_joins_by_shuffle_or_broadcast_alike(spark, scratch, threshold):
    """Spark alone decides how the split table is joined; no hint overrides its size check."""
    root = scratch("nohint")
    write_sides(spark, root, 1200, 3, 4, 17)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        with small_splits(spark):
            side = ordinal_index(read_delimited(spark, f"{root}/left", encoding="UTF-8"))
            plan = side.df._jdf.queryExecution().sparkPlan().toString()
            got = side.df.select(F.col("k").cast("long"), "_idx").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
    assert side.rows == 1200 and all(r[0] == r[1] for r in got)


def test_join_partitions_grow_with_the_splits(spark, scratch):
    """``spark.sql.shuffle.partitions`` stays fixed; the ordinal join follows the input."""
    root = scratch("growing")
    write_sides(spark, root, 4000, 2, 3, 23)
    parts = []
    for size in (1 << 22, 2048):
        with small_splits(spark, size):
            z = zip_by_position(read_delimited(spark, f"{root}/left", encoding="UTF-8"),
                                read_delimited(spark, f"{root}/right", encoding="UTF-8"), expected_overlap=["a"])
            plan = z._jdf.queryExecution().sparkPlan().toString()
            parts.append(max(int(n) for n in re.findall(r"REPARTITION_BY_NUM|, (\d+)\), REPARTITION", plan) if n))
            assert z.count() == 4000
    assert parts[0] == int(spark.conf.get("spark.sql.shuffle.partitions")) < parts[1]


def test_coalesced_id_pairing_is_wrong_where_ordinal_is_exact(spark, scratch):
    """Negative control for the trap the ordinal avoids: equal partition
    *counts* (``coalesce(8)``) + ``monotonically_increasing_id`` + inner join
    loses and mispairs rows once the two sides split differently."""
    root = scratch("naive")
    write_sides(spark, root, 6000, 3, 5, 50)
    with small_splits(spark, 8192):
        left = read_delimited(spark, f"{root}/left", encoding="UTF-8")
        right = read_delimited(spark, f"{root}/right", encoding="UTF-8")
        naive = (left.coalesce(8).withColumn("_i", F.monotonically_increasing_id())
                 .join(right.drop("a").coalesce(8).withColumn("_i", F.monotonically_increasing_id()), "_i"))
        naive_rows = naive.select(F.col("k").cast("long"), F.col("b").cast("long")).collect()
        exact = zip_by_position(left, right, expected_overlap=["a"])
        exact_rows = exact.select(F.col("k").cast("long"), F.col("b").cast("long")).collect()
    naive_ok = sum(1 for k, b in naive_rows if b == k + 1000)
    assert len(naive_rows) < 6000 or naive_ok < len(naive_rows)
    assert len(exact_rows) == 6000 and all(b == k + 1000 for k, b in exact_rows)


def test_whole_lineitem_aligned_by_position(spark, scratch):
    """All 600,000 lineitem rows (sf0.1) as two keyless CSV folders read with
    ~1 MB splits (dozens per side): every pair must match."""
    li = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").withColumn("k", F.monotonically_increasing_id())
    base = scratch("li-sides")
    (li.repartitionByRange(9, "k").sortWithinPartitions("k").select("k", "l_orderkey", "l_linenumber")
     .write.option("header", True).option("sep", ";").csv(f"{base}/left"))
    (li.repartitionByRange(14, "k").sortWithinPartitions("k")
     .select((F.col("k") * 3).alias("k3"), "l_quantity", F.repeat(F.lit("~"), (F.col("k") % 41).cast("int")).alias("pad"))
     .write.option("header", True).option("sep", ";").csv(f"{base}/right"))
    with small_splits(spark, 1 << 20):
        z = zip_by_position(read_delimited(spark, f"{base}/left", encoding="UTF-8"),
                            read_delimited(spark, f"{base}/right", encoding="UTF-8"))
        r = z.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.when(F.col("k").cast("long") * 3 != F.col("k3").cast("long"), 1).otherwise(0)).alias("bad")).first()
    assert (r["n"], r["bad"]) == (600000, 0)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(1, 2500), files=st.integers(1, 4), size=st.integers(600, 9000))
def test_pinned_index_equals_the_stored_one(spark, scratch, n, files, size):
    root = scratch("pinned")
    write_sides(spark, root, n, files, 2, 23)
    with small_splits(spark, size):
        df = read_delimited(spark, f"{root}/left", encoding="UTF-8")
        stored, pinned = ordinal_index(df), pinned_index(df)
        assert (pinned.rows, pinned.splits) == (stored.rows, stored.splits) == (n, stored.splits)
        got = pinned.df.select(F.col("k").cast("long"), "_idx").collect()
    assert sorted(map(tuple, got)) == [(i, i) for i in range(n)]


def test_pinned_index_keeps_no_copy_of_the_rows(spark, scratch):
    import os
    from lakemart.session import ensure_checkpoint_dir
    root = scratch("nocopy")
    write_sides(spark, root, 3000, 2, 3, 31)
    base = os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "lakemart-scratch")
    before = set(os.listdir(base))
    with small_splits(spark):
        side = pinned_index(read_delimited(spark, f"{root}/left", encoding="UTF-8"))
        new = [d for d in os.listdir(base) if d not in before]
        assert [d.rsplit("-", 1)[0] for d in new] == ["split-offsets"]
        assert spark.read.parquet(os.path.join(base, new[0])).count() == side.splits > 5
        counted = side.df.select("_idx")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in counted                       # ordinals alone need no column


def test_pinned_index_refuses_another_split_plan(spark, scratch):
    root = scratch("moved")
    write_sides(spark, root, 3000, 1, 2, 31)
    with small_splits(spark, 4096):
        side = pinned_index(read_delimited(spark, f"{root}/left", encoding="UTF-8"))
    with small_splits(spark, 1000), pytest.raises(Exception, match="split differently"):
        side.df.collect()
