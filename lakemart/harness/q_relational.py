"""Join, set, ordering and aggregation bindings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakemart.functions import count_where, harmonize, map_codes, mean, n, share_where
from lakemart.harness.common import ORDER_COLS, table
from lakemart.harness.q_schema import PRIORITY_LABELS
from lakemart.harness.registry import register
from lakemart.operators.aggregate import grouped_report, row_counts
from lakemart.operators.ordering import numbered, sorted_by, top_k, with_position
from lakemart.operators.positional import zip_by_position
from lakemart.operators.schema import conform
from lakemart.operators.sets import stack_periods
from lakemart.plans.fixtures import LEFT_FILES, RIGHT_FILES
from lakemart.session import Scratch, materialize, scratch_path
from lakemart.sources.files import read_delimited

ORDERS_FLAT = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
    StructField("o_orderpriority", StringType()),
])

# ---------------------------------------------------------------- J01 / U01


def write_positional_sides(spark, orders, base: str) -> tuple[str, str]:
    """orders in key order as two keyless CSV folders of different width and
    file count (narrow: key + status; wide: totals + padding)."""
    ordered = lambda k: orders.repartitionByRange(k, "o_orderkey").sortWithinPartitions("o_orderkey")
    (ordered(LEFT_FILES).select("o_orderkey", "o_custkey", "o_orderstatus")
     .write.option("header", True).option("sep", ";").csv(f"{base}/narrow"))
    (ordered(RIGHT_FILES).select("o_custkey", "o_totalprice", "o_orderpriority",
                                F.repeat(F.lit("#"), (F.col("o_orderkey") % 37).cast(IntegerType())).alias("padding"))
     .write.option("header", True).option("sep", ";").csv(f"{base}/wide"))
    return f"{base}/narrow", f"{base}/wide"


def zip_orders(spark, narrow_path: str, wide_path: str, scope: Scratch | None = None):
    """Re-align the two sides by position only and type the result."""
    narrow = read_delimited(spark, narrow_path, sep=";", encoding="UTF-8")
    wide = read_delimited(spark, wide_path, sep=";", encoding="UTF-8")
    return conform(zip_by_position(narrow, wide, expected_overlap=["o_custkey"], scope=scope), ORDERS_FLAT)


@register("j01_positional_join", f"SELECT {', '.join(ORDER_COLS)} FROM orders")
def j01(spark, sf_dir):
    with Scratch(spark) as scope:        # only the aligned result stays
        sides = write_positional_sides(spark, table(spark, sf_dir, "orders"), scratch_path(spark, "j01", scope))
        return materialize(zip_orders(spark, *sides, scope), "j01-result")


@register("u01_union_by_name", f"SELECT {', '.join(ORDER_COLS)} FROM orders")
def u01(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    early = o.where(F.year("o_orderdate") <= 1998).select(*ORDER_COLS)
    late = o.where(F.year("o_orderdate") > 1998).select(*reversed(ORDER_COLS))
    return stack_periods([early, late])


# ---------------------------------------------------------------- ordering


@register("o01_multi_key_sort", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(l_quantity) AS sum_qty,
       ROW_NUMBER() OVER (ORDER BY l_returnflag, l_linestatus) AS pos
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def o01(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_returnflag", "l_linestatus").agg(n().alias("n"), F.sum("l_quantity").alias("sum_qty"))
    return numbered(sorted_by(g, ["l_returnflag", "l_linestatus"]))


@register("o02_mixed_direction_sort", """
SELECT order_year, o_orderpriority, n,
       ROW_NUMBER() OVER (ORDER BY order_year, n DESC, o_orderpriority) AS pos
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderpriority, COUNT(*) AS n
      FROM orders GROUP BY 1, 2) g
""")
def o02(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    g = o.groupBy(F.year("o_orderdate").alias("order_year"), "o_orderpriority").agg(n().alias("n"))
    return numbered(sorted_by(g, [F.col("order_year"), F.col("n").desc(), F.col("o_orderpriority")]))


@register("o03_sort_by_unprojected_key", """
SELECT priority_label, n, pos FROM (
  SELECT o_orderpriority,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
      WHEN '3-MEDIUM' THEN 'medium' WHEN '4-NOT SPECIFIED' THEN 'unspecified' END AS priority_label,
    COUNT(*) AS n,
    ROW_NUMBER() OVER (ORDER BY o_orderpriority) AS pos
  FROM orders GROUP BY o_orderpriority) g
""")
def o03(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return numbered(grouped_report(o, ["o_orderpriority"], {"n": n()}, order=["o_orderpriority"],
                                   labels={"priority_label": map_codes("o_orderpriority", PRIORITY_LABELS)}))


def size_band():
    s = F.col("p_size")
    return harmonize([(s <= 10, "1. até 10"), (s <= 20, "2. 11 a 20"), (s <= 30, "3. 21 a 30"),
                      (s <= 40, "4. 31 a 40")], default="5. acima de 40")


@register("o04_sort_by_label", """
SELECT band, n, media_tamanho, ROW_NUMBER() OVER (ORDER BY band) AS pos
FROM (
  SELECT CASE WHEN p_size <= 10 THEN '1. até 10' WHEN p_size <= 20 THEN '2. 11 a 20'
              WHEN p_size <= 30 THEN '3. 21 a 30' WHEN p_size <= 40 THEN '4. 31 a 40'
              ELSE '5. acima de 40' END AS band,
         COUNT(*) AS n, ROUND(AVG(CAST(p_size AS DOUBLE)), 1) AS media_tamanho
  FROM part GROUP BY 1) g
""")
def o04(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return numbered(grouped_report(p, [size_band().alias("band")],
                                   {"n": n(), "media_tamanho": mean("p_size", as_double=True)}, order=["band"]))


@register("o05_top_k", """
SELECT o_orderkey, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def o05(spark, sf_dir):
    top = top_k(table(spark, sf_dir, "orders"), "o_totalprice", 20, tie_break=["o_orderkey"],
                cols=["o_orderkey", "o_totalprice"])
    return numbered(top)


@register("o06_global_positions", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       ROW_NUMBER() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos
FROM lineitem
""")
def o06(spark, sf_dir):
    """Positions of a whole table: range-sorted, offsets from per-partition counts."""
    li = table(spark, sf_dir, "lineitem")
    out = with_position(li, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pos")


# ---------------------------------------------------------------- aggregation


@register("a01_count_star", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def a01(spark, sf_dir):
    return grouped_report(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {"n": n()})


@register("a03_rounded_mean", """
SELECT l_returnflag, ROUND(AVG(l_quantity), 1) AS media_qty FROM lineitem GROUP BY l_returnflag
""")
def a03(spark, sf_dir):
    return grouped_report(table(spark, sf_dir, "lineitem"), ["l_returnflag"], {"media_qty": mean("l_quantity")})


@register("a04_mean_of_cast", """
SELECT p_brand, ROUND(AVG(CAST(p_size AS DOUBLE)), 1) AS media_tamanho FROM part GROUP BY p_brand
""")
def a04(spark, sf_dir):
    return grouped_report(table(spark, sf_dir, "part"), ["p_brand"],
                          {"media_tamanho": mean("p_size", as_double=True)})


@register("a05_conditional_count", """
SELECT l_linestatus, SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS returned
FROM lineitem GROUP BY l_linestatus
""")
def a05(spark, sf_dir):
    return grouped_report(table(spark, sf_dir, "lineitem"), ["l_linestatus"],
                          {"returned": count_where(F.col("l_returnflag") == "R")})


@register("a06_percentage_share", """
SELECT l_returnflag,
  ROUND(CAST(100.0 AS DOUBLE) * SUM(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) / COUNT(*), 1)
    AS pct_discounted
FROM lineitem GROUP BY l_returnflag
""")
def a06(spark, sf_dir):
    return grouped_report(table(spark, sf_dir, "lineitem"), ["l_returnflag"],
                          {"pct_discounted": share_where(F.col("l_discount") >= F.lit(0.05))})


@register("a07_three_key_group", """
SELECT l_returnflag, l_linestatus, l_linenumber, COUNT(*) AS n, ROUND(AVG(l_quantity), 1) AS media_qty
FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber
""")
def a07(spark, sf_dir):
    return grouped_report(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"],
                          {"n": n(), "media_qty": mean("l_quantity")})


SHORT_PRIORITY = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}


@register("a08_group_code_label", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
         WHEN '3-MEDIUM' THEN 'medium' END AS priority_label,
       COUNT(*) AS n
FROM orders GROUP BY o_orderpriority
""")
def a08(spark, sf_dir):
    return grouped_report(table(spark, sf_dir, "orders"), ["o_orderpriority"], {"n": n()},
                          labels={"priority_label": map_codes("o_orderpriority", SHORT_PRIORITY)})


SIZE_9 = {i: f"0{i}. tamanho {i}" for i in range(1, 9)}


@register("a09_group_expression", """
SELECT CASE p_size WHEN 1 THEN '01. tamanho 1' WHEN 2 THEN '02. tamanho 2' WHEN 3 THEN '03. tamanho 3'
         WHEN 4 THEN '04. tamanho 4' WHEN 5 THEN '05. tamanho 5' WHEN 6 THEN '06. tamanho 6'
         WHEN 7 THEN '07. tamanho 7' WHEN 8 THEN '08. tamanho 8' ELSE '09. tamanho 9+' END AS faixa,
       COUNT(*) AS n, ROUND(AVG(CAST(p_size AS DOUBLE)), 1) AS media_tamanho
FROM part GROUP BY 1
""")
def a09(spark, sf_dir):
    band = map_codes("p_size", SIZE_9, default="09. tamanho 9+").alias("faixa")
    return grouped_report(table(spark, sf_dir, "part"), [band],
                          {"n": n(), "media_tamanho": mean("p_size", as_double=True)})


AUDITED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@register("a10_row_audit", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM {t}" for t in AUDITED))
def a10(spark, sf_dir):
    return row_counts({t: table(spark, sf_dir, t) for t in AUDITED}).withColumnRenamed("table", "table_name")
