"""Filter bindings on the supplied tables (F03, F04, F06, F07; F01/F02 live
with the partitioned sources, F05/F08/F09 with the exam table)."""

from __future__ import annotations

from lakemart.functions import eligible
from lakemart.harness.common import table
from lakemart.harness.registry import register


@register("f03_numeric_equality", "SELECT doc_id, quality, toxic FROM labels WHERE quality = 1")
def f03(spark, sf_dir):
    return table(spark, sf_dir, "labels").where(eligible(equal={"quality": 1}))


@register("f04_strictly_positive", "SELECT * FROM customer WHERE c_acctbal > 0")
def f04(spark, sf_dir):
    return table(spark, sf_dir, "customer").where(eligible(positive=["c_acctbal"]))


@register("f06_between", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 1 AND 5")
def f06(spark, sf_dir):
    return table(spark, sf_dir, "part").where(eligible(between={"p_size": (1, 5)})).select("p_partkey", "p_name", "p_size")


@register("f07_in_list", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
WHERE l_returnflag IN ('R', 'A') AND l_quantity IN (1, 2, 3)
""")
def f07(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return (li.where(eligible(isin={"l_returnflag": ["R", "A"], "l_quantity": [1, 2, 3]}))
            .select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"))
