"""Games-notebook bindings (M10–M12) on the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lakemart.functions import count_where, n
from lakemart.harness.common import table
from lakemart.harness.registry import register
from lakemart.plans.games import entry_ratios, export_csv, load_tables, top_list
from lakemart.session import scratch_path
from lakemart.sources.files import write_csv


@register("m10_top_list", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def m10(spark, sf_dir):
    path = scratch_path(spark, "m10")
    write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), path)
    loaded = load_tables(spark, {"orders": path})["orders"]
    return top_list(loaded, "o_totalprice", "o_orderkey").select(
        F.col("o_orderkey").cast(LongType()).alias("o_orderkey"), "o_totalprice")


@register("m11_entry_ratios", """
SELECT n_name AS Discipline, CAST(Female AS INTEGER) AS Female, CAST(Male AS INTEGER) AS Male,
       CAST(Total AS INTEGER) AS Total,
       Female / Total AS Avg_Female, Male / Total AS Avg_Male
FROM (
  SELECT c_nationkey,
         SUM(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) AS Female,
         SUM(CASE WHEN c_acctbal <= 0 THEN 1 ELSE 0 END) AS Male,
         COUNT(*) AS Total
  FROM customer GROUP BY c_nationkey
) e JOIN nation ON n_nationkey = c_nationkey
""")
def m11(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    per = c.groupBy("c_nationkey").agg(count_where(F.col("c_acctbal") > 0).alias("Female"),
                                       count_where(F.col("c_acctbal") <= 0).alias("Male"),
                                       n().alias("Total"))
    entries = (per.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
               .select(F.col("n_name").alias("Discipline"), "Female", "Male", "Total"))
    path = scratch_path(spark, "m11")
    write_csv(entries, path)
    loaded = load_tables(spark, {"entriesgender": path})["entriesgender"]
    return entry_ratios(loaded, {"Avg_Female": "Female", "Avg_Male": "Male"}, "Total")


# every exported column of every table, brought to one row shape: (SQL text valid in both engines)
EXPORTED = {
    "supplier": "CAST(s_suppkey AS BIGINT), s_name, s_nationkey, CAST(NULL AS {text}), CAST(NULL AS {text}), s_acctbal",
    "nation": "CAST(n_nationkey AS BIGINT), n_name, n_regionkey, CAST(NULL AS {text}), CAST(NULL AS {text}), CAST(NULL AS DOUBLE)",
    "region": "CAST(r_regionkey AS BIGINT), r_name, CAST(NULL AS INTEGER), CAST(NULL AS {text}), CAST(NULL AS {text}), CAST(NULL AS DOUBLE)",
    "customer": "CAST(c_custkey AS BIGINT), c_name, c_nationkey, c_mktsegment, CAST(NULL AS {text}), c_acctbal",
    "part": "CAST(p_partkey AS BIGINT), p_name, p_size, p_brand, p_type, p_retailprice",
}
CELLS = ["id", "name", "number", "text1", "text2", "amount"]


@register("m12_csv_export", "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{t}', {cells.format(text='VARCHAR')} FROM {t}" for t, cells in EXPORTED.items())
    + f") AS cells(table_name, {', '.join(CELLS)})")
def m12(spark, sf_dir):
    tables = {t: table(spark, sf_dir, t) for t in EXPORTED}
    paths = export_csv(tables, scratch_path(spark, "m12"))
    out = None
    for t, path in paths.items():
        back = spark.read.schema(tables[t].schema).option("header", True).csv(path)
        texts = EXPORTED[t].format(text="STRING").replace("INTEGER", "INT")
        cells = back.selectExpr(f"'{t}' AS table_name", f"struct({texts}) AS c").select("table_name", "c.*").toDF("table_name", *CELLS)
        out = cells if out is None else out.union(cells)
    return out
