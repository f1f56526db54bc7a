"""Command line: ``python -m lakemart <command> ...``

  bronze     raw CSV releases → period-partitioned Parquet bronze
  lakehouse  bronze → staging view → mart tables → expectations → gate
  reports    the four ad-hoc reports over a bronze dataset or a table of the catalog, as CSV

Raw inputs are given per period: ``--single 2023=<file or folder>`` for a
unified release, ``--split 2024=<participants>,<results>`` for two keyless
files aligned by position.  ``bronze --keep-going`` publishes period by period: a period that fails is
reported with its error, the others are published, and the command ends with status 1.
"""

from __future__ import annotations

import argparse
import json
import sys

from lakemart.session import build_session


def _inputs(args):
    from lakemart.plans.exam.bronze import BronzeInputs
    single = dict(s.split("=", 1) for s in args.single or [])
    split = {p: tuple(v.split(",", 1)) for p, v in (s.split("=", 1) for s in args.split or [])}
    return BronzeInputs(single=single, split=split, sep=args.sep, encoding=args.encoding)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="lakemart")
    sub = ap.add_subparsers(dest="command", required=True)
    for name in ("bronze", "lakehouse"):
        p = sub.add_parser(name)
        p.add_argument("--single", action="append", help="PERIOD=path of a unified release")
        p.add_argument("--split", action="append", help="PERIOD=left,right keyless pair")
        p.add_argument("--sep", default=";")
        p.add_argument("--encoding", default="ISO-8859-1")
        p.add_argument("--bronze", required=True, help="bronze dataset path")
        p.add_argument("--dynamic", action="store_true", help="replace only the periods given")
        if name == "bronze":
            p.add_argument("--keep-going", action="store_true", help="period by period; report those that fail")
        if name == "lakehouse":
            p.add_argument("--marts", required=True, help="folder for the mart tables")
            p.add_argument("--database", default="default")
    r = sub.add_parser("reports")
    source = r.add_mutually_exclusive_group(required=True)
    source.add_argument("--bronze", help="bronze dataset path")
    source.add_argument("--table", help="registered bronze table, DATABASE.TABLE")
    r.add_argument("--out", required=True)
    r.add_argument("--period", default="2024")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    if args.command == "bronze":
        from lakemart.plans.exam.bronze import build_bronze, build_periods
        if args.keep_going:
            info = build_periods(spark, _inputs(args), args.bronze)
        else:
            info = build_bronze(spark, _inputs(args), args.bronze, dynamic=args.dynamic)
    elif args.command == "lakehouse":
        from lakemart.plans.lakehouse import LakehouseConfig, run_lakehouse
        info = run_lakehouse(spark, LakehouseConfig(inputs=_inputs(args), bronze_path=args.bronze,
                                                    marts_path=args.marts, database=args.database,
                                                    dynamic=args.dynamic))
    else:
        from lakemart.plans.exam import adhoc
        from lakemart.plans.exam.bronze import read_bronze
        from lakemart.sources.files import write_csv
        bronze = spark.table(args.table) if args.table else read_bronze(spark, args.bronze)
        reports = {"income_by_sex": adhoc.income_by_sex(bronze, args.period),
                   "race_by_year": adhoc.race_by_year(bronze),
                   "mother_schooling": adhoc.mother_schooling(bronze, args.period),
                   "income_band_by_school": adhoc.income_band_by_school(bronze, args.period)}
        for name, df in reports.items():
            write_csv(df, f"{args.out.rstrip('/')}/{name}")
        info = {"reports": list(reports)}
    print(json.dumps(info, default=str))
    return 1 if info.get("failures") else 0


if __name__ == "__main__":
    sys.exit(main())
