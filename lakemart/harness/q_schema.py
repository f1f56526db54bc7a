"""Schema-conformance and projection bindings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakemart.functions import (bucket_by_membership, code_to_bool, count_where, lenient_cast,
                                map_codes, n, rounded, typed_null)
from lakemart.harness.common import ORDER_COLS, table
from lakemart.harness.registry import register
from lakemart.operators.aggregate import ratios
from lakemart.operators.schema import conform, drop_overlap, extend, lower_names, pick, rename, tag


@register("p01_lower_names", "SELECT r_regionkey, r_name FROM region")
def p01(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    shouting = r.toDF(*[c.upper() for c in r.columns])
    return lower_names(shouting)


PART_TARGET = StructType([
    StructField("p_partkey", LongType()), StructField("p_name", StringType()),
    StructField("p_brand", StringType()), StructField("p_size", IntegerType()),
    StructField("p_retailprice", DoubleType()),
    StructField("p_container", StringType()), StructField("p_comment", StringType()),
])


@register("p02_conform", """
SELECT p_partkey, p_name, p_brand,
       CASE p_partkey % 8 WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 2 THEN p_size WHEN 3 THEN p_size
         WHEN 4 THEN 0 WHEN 5 THEN 0 END::INTEGER AS p_size,
       CASE WHEN p_partkey % 5 < 3 THEN p_retailprice END AS p_retailprice,
       CAST(NULL AS VARCHAR) AS p_container, CAST(NULL AS VARCHAR) AS p_comment
FROM part
""")
def p02(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    # every column as text (as a raw CSV would deliver it, unclean), permuted, plus an extra one
    size, price = F.col("p_size").cast(StringType()), F.col("p_retailprice").cast(StringType())
    k = F.col("p_partkey")
    dirty = {"p_size": F.element_at(F.array(size, F.concat(size, F.lit(".0")), F.concat(F.lit(" \t"), size, F.lit("\n")),
                                            F.concat(size, F.lit(".75\t")), F.lit(".5"), F.lit("-.7"), F.lit(""), F.lit("n/a")),
                                    (k % 8).cast(IntegerType()) + 1),
             "p_retailprice": F.element_at(F.array(price, F.concat(F.lit(" "), price), F.concat(price, F.lit("\t")), F.lit("  "), F.lit("free")),
                                           (k % 5).cast(IntegerType()) + 1)}
    as_text = p.select(*[dirty.get(c, F.col(c).cast(StringType())).alias(c) for c in reversed(p.columns)],
                       F.lit("x").alias("p_extra"))
    return conform(as_text, PART_TARGET)


@register("p03_tag_literal", "SELECT n_nationkey, n_name, n_regionkey, '2024' AS ano FROM nation")
def p03(spark, sf_dir):
    return tag(table(spark, sf_dir, "nation"), "ano", "2024")


@register("p04_drop_overlap", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def p04(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    left = o.select("o_orderkey", "o_custkey", "o_orderstatus")
    right = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    right = drop_overlap(left, right, expected=["o_custkey"], keep=["o_orderkey"])
    return left.join(right, "o_orderkey").select(*ORDER_COLS)


@register("p05_pick", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def p05(spark, sf_dir):
    return pick(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@register("p06_rename", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer
""")
def p06(spark, sf_dir):
    return rename(table(spark, sf_dir, "customer"), {"c_custkey": "customer_id", "c_name": "customer_name"})


@register("p07_extend", """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
""")
def p07(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return extend(o, order_year=F.year("o_orderdate"))


PRIORITY_LABELS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium",
                   "4-NOT SPECIFIED": "unspecified"}


@register("p08_map_codes", """
SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
    WHEN '3-MEDIUM' THEN 'medium' WHEN '4-NOT SPECIFIED' THEN 'unspecified' END AS priority_label
FROM orders
""")
def p08(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", map_codes("o_orderpriority", PRIORITY_LABELS).alias("priority_label"))


@register("p09_map_codes_default", """
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'third' ELSE 'later' END
    AS line_label
FROM lineitem
""")
def p09(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     map_codes("l_linenumber", {1: "first", 2: "second", 3: "third"}, default="later")
                     .alias("line_label"))


# a long book with text codes over numbers: INT 1 meets '01', DOUBLE 2.0 meets '2'
SIZE_BOOK = {f"{i:02d}": f"size {i}" for i in range(1, 28)}
LINE_BOOK = {str(i): f"line {i}" for i in range(1, 8)}


@register("p08_long_book_over_numbers", """
SELECT p_partkey, CASE WHEN p_size <= 27 THEN 'size ' || p_size END AS size_label,
       CASE WHEN p_partkey % 9 BETWEEN 1 AND 7 THEN 'line ' || (p_partkey % 9) ELSE 'other' END AS line_label
FROM part
""")
def p08_numbers(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("line", (F.col("p_partkey") % 9).cast(DoubleType()))
    return p.select("p_partkey", map_codes("p_size", SIZE_BOOK).alias("size_label"), map_codes("line", LINE_BOOK, default="other").alias("line_label"))


@register("p10_code_to_bool", """
SELECT doc_id,
  CASE toxic WHEN 1 THEN true WHEN 0 THEN false END AS is_toxic,
  CASE quality WHEN 1 THEN true WHEN 0 THEN false END AS is_quality
FROM labels
""")
def p10(spark, sf_dir):
    lb = table(spark, sf_dir, "labels")
    return lb.select("doc_id", code_to_bool("toxic").alias("is_toxic"), code_to_bool("quality").alias("is_quality"))


NATION_GROUPS = {"g1": [0, 1, 2, 3, 4], "g2": [5, 6, 7, 8, 9], "g3": [10, 11, 12, 13, 14],
                 "g4": [15, 16, 17], "g5": [18, 19, 20]}


@register("p14_bucket_by_membership", """
SELECT c_custkey, c_nationkey,
  CASE WHEN c_nationkey IN (0, 1, 2, 3, 4) THEN 'g1'
       WHEN c_nationkey IN (5, 6, 7, 8, 9) THEN 'g2'
       WHEN c_nationkey IN (10, 11, 12, 13, 14) THEN 'g3'
       WHEN c_nationkey IN (15, 16, 17) THEN 'g4'
       WHEN c_nationkey IN (18, 19, 20) THEN 'g5' END AS nation_group
FROM customer
""")
def p14(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", "c_nationkey", bucket_by_membership("c_nationkey", NATION_GROUPS).alias("nation_group"))


@register("p15_casts", """
SELECT o_orderkey,
  CAST(CAST(year(o_orderdate) AS VARCHAR) AS INTEGER) AS order_year,
  CAST(o_custkey % 10 AS INTEGER) AS cust_bucket,
  CAST(o_custkey AS DOUBLE) AS cust_as_double
FROM orders
""")
def p15(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    year_text = F.year("o_orderdate").cast(StringType())
    return o.select("o_orderkey",
                    lenient_cast(year_text, IntegerType()).alias("order_year"),
                    (F.col("o_custkey") % 10).cast(IntegerType()).alias("cust_bucket"),
                    F.col("o_custkey").cast(DoubleType()).alias("cust_as_double"))


@register("p16_round", """
SELECT l_orderkey, l_linenumber, l_quantity, ROUND(l_quantity / 4, 1) AS quarter_qty FROM lineitem
""")
def p16(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     rounded(F.col("l_quantity") / F.lit(4.0), 1).alias("quarter_qty"))


@register("p18_ratios", """
SELECT c_nationkey, positive, negative, total,
       positive / total AS share_positive, negative / total AS share_negative
FROM (
  SELECT c_nationkey,
         SUM(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END)::BIGINT AS positive,
         SUM(CASE WHEN c_acctbal <= 0 THEN 1 ELSE 0 END)::BIGINT AS negative,
         COUNT(*) AS total
  FROM customer GROUP BY c_nationkey
) counts
""")
def p18(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    counts = c.groupBy("c_nationkey").agg(count_where(F.col("c_acctbal") > 0).alias("positive"),
                                          count_where(F.col("c_acctbal") <= 0).alias("negative"),
                                          n().alias("total"))
    return ratios(counts, {"share_positive": "positive", "share_negative": "negative"}, "total")


@register("p19_typed_nulls", """
SELECT r_regionkey, r_name, CAST(NULL AS BIGINT) AS missing_long,
       CAST(NULL AS DOUBLE) AS missing_double, CAST(NULL AS VARCHAR) AS missing_text
FROM region
""")
def p19(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    return r.select("*", typed_null(LongType()).alias("missing_long"),
                    typed_null(DoubleType()).alias("missing_double"),
                    typed_null(StringType()).alias("missing_text"))
