"""Source / sink / catalog bindings.

Round trips write below the shared checkpoint directory (a fresh folder per
call) and return the re-read DataFrame, so the check covers write + read.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from lakemart.harness.common import ORDER_COLS, orders_with_year, staging, table
from lakemart.harness.q_relational import ORDERS_FLAT
from lakemart.harness.registry import register
from lakemart.harness.sqltext import MART_STATE_SQL, with_stg
from lakemart.operators.schema import conform
from lakemart.plans.exam.marts import mart_state
from lakemart.session import scratch_path
from lakemart.sources import (as_table, as_view, preview, raw_inventory, read_delimited,
                              read_inferred, read_period, read_pinned, register_table,
                              scan_periods, schema_drift, write_csv, write_partitioned)

CUSTOMER_TEXT = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()), StructField("cidade", StringType()),
])
ORDERS_BY_YEAR = StructType(ORDERS_FLAT.fields + [StructField("ano", StringType())])
FLAT = ", ".join(ORDER_COLS)


def _named(name: str) -> str:
    """One fixed catalog name per query: a new run replaces the table of the last one."""
    return f"lm_{name}"


@register("s01_read_delimited", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       'São ' || CAST(c_custkey % 50 AS VARCHAR) AS cidade
FROM customer
""")
def s01(spark, sf_dir):
    path = scratch_path(spark, "s01")
    c = table(spark, sf_dir, "customer")
    raw = c.select(*[F.col(x).alias(x.upper()) for x in c.columns],
                   F.concat(F.lit("São "), (F.col("c_custkey") % 50).cast(StringType())).alias("CIDADE"))
    write_csv(raw, path, sep=";", encoding="ISO-8859-1")
    back = read_delimited(spark, path, sep=";", encoding="ISO-8859-1")
    return conform(back.toDF(*[x.lower() for x in back.columns]), CUSTOMER_TEXT)


@register("s02_read_inferred", "SELECT * FROM nation")
def s02(spark, sf_dir):
    path = scratch_path(spark, "s02")
    write_csv(table(spark, sf_dir, "nation"), path)
    return read_inferred(spark, path)


@register("s02_read_pinned", """
SELECT *, 'bigint,bigint,string,double,timestamp,string' AS types FROM orders
""")
def s02_pinned(spark, sf_dir):
    """The first read infers all orders' types and pins them; the second one, returned, parses once by the pin."""
    path = scratch_path(spark, "s02p")
    o = table(spark, sf_dir, "orders")
    # keys beyond the ints, and a time of day, so that the types are those of the table at every scale
    wide = [(F.col(c) + F.lit(1 << 40)).alias(c) for c in ("o_orderkey", "o_custkey")]
    noon = (F.col("o_orderdate").cast("timestamp") + F.expr("interval 12 hours")).alias("o_orderdate")
    write_csv(o.select(*wide, "o_orderstatus", "o_totalprice", noon, "o_orderpriority"), path)
    read_pinned(spark, path)
    back = read_pinned(spark, path)
    types = ",".join(f.dataType.simpleString() for f in back.schema.fields)
    narrow = [(F.col(c) - F.lit(1 << 40)).alias(c) for c in ("o_orderkey", "o_custkey")]
    morning = (F.col("o_orderdate") - F.expr("interval 12 hours")).cast("timestamp_ntz").alias("o_orderdate")
    return back.select(*narrow, "o_orderstatus", "o_totalprice", morning, "o_orderpriority", F.lit(types).alias("types"))


def _orders_csv_by_year(spark, sf_dir) -> str:
    root = scratch_path(spark, "orders_raw")
    (orders_with_year(spark, sf_dir).write.partitionBy("ano")
     .option("header", True).option("sep", ";").csv(root))
    return root


@register("s03_read_period", f"SELECT {FLAT} FROM orders WHERE year(o_orderdate) = 1997")
def s03(spark, sf_dir):
    root = _orders_csv_by_year(spark, sf_dir)
    return conform(read_period(spark, root, "1997", encoding="UTF-8"), ORDERS_FLAT)


def _orders_bronze(spark, sf_dir) -> str:
    path = scratch_path(spark, "orders_by_year")
    write_partitioned(orders_with_year(spark, sf_dir), path, "ano")
    return path


ORDERS_YEAR_SQL = f"SELECT {FLAT}, CAST(year(o_orderdate) AS VARCHAR) AS ano FROM orders"


@register("s04_write_partitioned", ORDERS_YEAR_SQL)
def s04(spark, sf_dir):
    return spark.read.schema(ORDERS_BY_YEAR).parquet(_orders_bronze(spark, sf_dir))


@register("s05_write_csv", "SELECT * FROM supplier")
def s05(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "s05")
    write_csv(s, path)
    return spark.read.schema(s.schema).option("header", True).csv(path)


@register("s05_write_csv_files", "SELECT *, 3 AS files FROM supplier")
def s05_files(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "s05f")
    write_csv(s, path, files=3)
    parts = raw_inventory(spark, path).count()
    return spark.read.schema(s.schema).option("header", True).csv(path).withColumn("files", F.lit(parts))


@register("s06_register_table", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS ano, COUNT(*) AS n FROM orders GROUP BY 1
""")
def s06(spark, sf_dir):
    name = _named("s06_orders")
    register_table(spark, name, _orders_bronze(spark, sf_dir), ORDERS_BY_YEAR, ["ano"])
    return spark.sql(f"SELECT ano, COUNT(*) AS n FROM {name} GROUP BY ano")


@register("s06_schema_drift", """
SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS ano, v."column", v.declared, v.found, v.problem
FROM orders, (VALUES ('o_totalprice', 'double', 'string', 'type'),
                     ('o_orderpriority', 'string', NULL, 'missing'),
                     ('o_note', NULL, 'int', 'extra')) v("column", declared, found, problem)
WHERE year(o_orderdate) IN (1996, 1998) AND (year(o_orderdate) = 1996) = (v.problem = 'type')
""")
def s06_drift(spark, sf_dir):
    """Orders by year, 1996 delivered with a price as text and 1998 with one column less and one more."""
    path = scratch_path(spark, "s06_drift")
    o = orders_with_year(spark, sf_dir)
    write_partitioned(o.where("ano not in ('1996', '1998')"), path, "ano")
    write_partitioned(o.where("ano = '1996'").withColumn("o_totalprice", F.col("o_totalprice").cast("string")), path, "ano", mode="append")
    write_partitioned(o.where("ano = '1998'").drop("o_orderpriority").withColumn("o_note", F.lit(1)), path, "ano", mode="append")
    return schema_drift(spark, path, ORDERS_BY_YEAR, ["ano"]).drop("path").distinct()


@register("s07_scan_periods", f"{ORDERS_YEAR_SQL} WHERE year(o_orderdate) = 1997")
def s07(spark, sf_dir):
    name = _named("s07_orders")
    register_table(spark, name, _orders_bronze(spark, sf_dir), ORDERS_BY_YEAR, ["ano"])
    return scan_periods(spark, name, ["1997"])


@register("f01_partition_equality", f"{ORDERS_YEAR_SQL} WHERE year(o_orderdate) = 1996")
def f01(spark, sf_dir):
    df = spark.read.schema(ORDERS_BY_YEAR).parquet(_orders_bronze(spark, sf_dir))
    return df.where(F.col("ano") == "1996")


@register("f02_partition_in_list", f"{ORDERS_YEAR_SQL} WHERE year(o_orderdate) IN (1995, 2000)")
def f02(spark, sf_dir):
    df = spark.read.schema(ORDERS_BY_YEAR).parquet(_orders_bronze(spark, sf_dir))
    return df.where(F.col("ano").isin("1995", "2000"))


@register("s08_staging_view", with_stg("""
SELECT ano, sexo, COUNT(*) AS total FROM stg GROUP BY ano, sexo
"""))
def s08(spark, sf_dir):
    name = _named("s08_stg_exam")
    as_view(staging(spark, sf_dir), name)
    return spark.sql(f"SELECT ano, sexo, COUNT(*) AS total FROM {name} GROUP BY ano, sexo")


@register("s09_mart_table", with_stg(MART_STATE_SQL))
def s09(spark, sf_dir):
    name = _named("s09_mart_state")
    return as_table(mart_state(staging(spark, sf_dir), ordered=False), name,
                    path=scratch_path(spark, "s09"))


@register("s10_raw_inventory", """
SELECT '2023' AS period, 'region' AS folder, count(*) > 0 AS present FROM region
UNION ALL SELECT '2024', 'nation', count(*) > 0 FROM nation
UNION ALL SELECT '2024', 'supplier', count(*) > 0 FROM supplier
""")
def s10(spark, sf_dir):
    """Releases unpacked per year: data CSVs under DADOS/, documentation
    elsewhere, below a root that itself has a folder of that name; only CSVs whose path inside
    the release begins with DADOS/ are inventoried (part names and sizes left out)."""
    root = scratch_path(spark, "raw_zone") + "/dados/raw"
    write_csv(table(spark, sf_dir, "region"), f"{root}/ano=2023/DADOS/region")
    write_csv(table(spark, sf_dir, "nation"), f"{root}/ano=2024/DADOS/nation")
    write_csv(table(spark, sf_dir, "supplier"), f"{root}/ano=2024/DADOS/supplier")
    write_csv(table(spark, sf_dir, "part"), f"{root}/ano=2024/LEIA-ME/part")
    write_csv(table(spark, sf_dir, "part"), f"{root}/ano=2024/EXTRA/DADOS/part")
    table(spark, sf_dir, "region").select("r_name").write.text(f"{root}/ano=2024/DADOS/notes")
    inv = raw_inventory(spark, root, folder="dados")
    folder = F.regexp_extract("path", r"/DADOS/([^/]+)/[^/]+$", 1).alias("folder")
    return inv.groupBy("period", folder).agg((F.sum("length") > 0).alias("present"))


@register("s11_preview", "SELECT * FROM nation ORDER BY n_nationkey LIMIT 20")
def s11(spark, sf_dir):
    return preview(table(spark, sf_dir, "nation"), 20, by="n_nationkey")
