"""Command line.

    python -m laborstar etl RAW_DIR WAREHOUSE_DIR [--as-of YYYY-MM-DD] [--wage-year N] [--mode blocks|lines|whole] [--changes]
    python -m laborstar report WAREHOUSE_DIR [NAME ...] [--profile-code CODE] [--output DIR]
    python -m laborstar sql WAREHOUSE_DIR "SELECT ... FROM dim_occupation ..." [--rows N] [--output DIR]

``etl`` loads the warehouse from the raw files (unchanged files are not read
again, and with ``--changes`` only changed code ranges are rewritten) and prints the load audit, the
values lost to coercion and the validation report; ``report`` prints reports over a stored
warehouse (all of them when no name is given); ``sql`` runs one ad hoc
statement over the stored tables, registered as views under their table
names. Every row is printed, or written by Spark as Parquet with
``--output``. All use the active session configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from laborstar.plans import marts
from laborstar.plans.pipeline import run_etl
from laborstar.plans.reports import reports
from laborstar.session import get_session
from laborstar.sources import files
from laborstar.sources.warehouse import StoredWarehouse


def emit(df: DataFrame, output: str | None = None) -> None:
    """Print every row, tab-separated, one partition at a time; or write them as Parquet."""
    if output:
        df.write.parquet(output)
        print(f"written to {output}")
        return
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="laborstar")
    sub = parser.add_subparsers(dest="command", required=True)
    etl = sub.add_parser("etl", help="load raw files into the warehouse, then validate")
    etl.add_argument("raw_dir")
    etl.add_argument("warehouse_dir")
    etl.add_argument("--as-of", default=None, help="load date for files without a date column")
    etl.add_argument("--wage-year", type=int, default=2023)
    etl.add_argument("--mode", choices=files.MODES, default="blocks",
                     help="how delimited files are read: by blocks (parallel), by lines (parallel, no field spans lines), whole (one task a file)")
    etl.add_argument("--changes", action="store_true", help="rewrite only the code ranges that changed")
    rep = sub.add_parser("report", help="print reports over a stored warehouse")
    rep.add_argument("warehouse_dir")
    rep.add_argument("names", nargs="*")
    rep.add_argument("--profile-code", default=marts.PROFILE_CODE)
    rep.add_argument("--output", default=None, help="write each report as Parquet under this folder")
    adhoc = sub.add_parser("sql", help="run one SQL statement over the stored tables")
    adhoc.add_argument("warehouse_dir")
    adhoc.add_argument("statement")
    adhoc.add_argument("--rows", type=int, default=None, help="print at most so many rows")
    adhoc.add_argument("--output", default=None, help="write the result as Parquet into this folder")
    args = parser.parse_args(argv)

    spark = get_session()
    if args.command == "etl":
        result = run_etl(spark, args.raw_dir, args.warehouse_dir, as_of=args.as_of,
                         wage_year=args.wage_year, mode=args.mode, changes=args.changes)
        emit(result.audit)
        emit(result.losses)
        checks = result.report.collect()                        # six rows, evaluated once
        for row in checks:
            print(f"{row['check']}\t{row['violations']}\t{'passed' if row['passed'] else 'FAILED'}")
        failed = sum(not row["passed"] for row in checks)
        print("All checks passed" if failed == 0 else f"Some checks FAILED ({failed} of 6)")
    elif args.command == "sql":
        StoredWarehouse(spark, args.warehouse_dir).register_views()
        found = spark.sql(args.statement)
        emit(found if args.rows is None else found.limit(args.rows), args.output)
    else:
        available = reports(StoredWarehouse(spark, args.warehouse_dir), args.profile_code)
        for name in args.names or list(available):
            print(f"== {name}")
            emit(available[name], args.output and f"{args.output.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()
