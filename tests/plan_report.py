"""Markdown table of physical-plan shape per registered query.

Usage: python tests/plan_report.py [sf_dir]
Counts shuffle exchanges, broadcasts, sorts, scans and columns read, so a
plan regression (an extra shuffle, a lost pushdown) shows up in review.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(df) -> dict:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    tree = text.split("\n\n")[0]
    nodes = [n.strip() for n in re.findall(r"([A-Za-z]+(?: [A-Za-z]+)*)\s+\(\d+\)", tree)]
    read = [len(m.split(",")) for m in re.findall(r"ReadSchema: struct<(.*)>", text)]
    return {
        "shuffles": sum(1 for n in nodes if n == "Exchange"),
        "broadcasts": sum(1 for n in nodes if n == "BroadcastExchange"),
        "sorts": sum(1 for n in nodes if n == "Sort" or n == "TakeOrderedAndProject"),
        "scans": sum(1 for n in nodes if n.startswith("Scan")),
        "cols_read": "/".join(map(str, read)) or "-",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]+\]", text) else "no",
        "partition_filter": "yes" if re.search(r"PartitionFilters: \[[^\]]+\]", text) else "no",
        "python": "yes" if "ArrowEvalPython" in text or "BatchEvalPython" in text else "no",
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from lakemart import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["shuffles", "broadcasts", "sorts", "scans", "cols_read", "pushed", "partition_filter", "python"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in E.queries().items():
        s = shape(fn(spark, sf_dir))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
