"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name-prefix ...]
Comparison mirrors the driver: column names sorted, row count, and an
order-insensitive multiset of rows.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT",
                 "float": "FLOAT"}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return repr(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2), note="rows-only")
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    if sorted(scols) != sorted(dcols):
        out.update(ok=False, note=f"columns differ: {scols} vs {dcols}")
        return out
    dtypes = {d[0]: str(d[1]) for d in res.description}
    tmis = [(f.name, f.dataType.simpleString(), dtypes.get(f.name)) for f in sdf.schema.fields
            if SPARK_TO_DUCK.get(f.dataType.simpleString()) != dtypes.get(f.name)]
    if tmis:
        out["type_note"] = str(tmis)
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        diff2 = [x for x in b if x not in set(a)][:3]
        out.update(ok=False, note=f"values differ; spark-only {diff} oracle-only {diff2}")
        return out
    out.update(ok=True)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    import __spark_entry__ as E
    extra = dict(kv.split("=", 1) for kv in os.environ.get("EXTRA_CONF", "").split(",") if kv)
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        b = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        for k, v in extra.items():
            b = b.config(k, v)
        spark = b.getOrCreate()
    else:
        from lakemart import build_session
        spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            r = compare(spark, con, name, fn, orc.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, ok=False, note=f"error: {type(e).__name__}: {str(e)[:300]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"queries={len(qs)} oracles={len(orc)} failures={bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
