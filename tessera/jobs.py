"""Driver entry points for ``spark-submit`` (or ``python -m tessera.jobs``).

    spark-submit tessera/jobs.py import --input <shard dir> --parquet <out> [--columns <dir>] \
        [--casts <json>] [--no-multiline] [--reduced <out>] [--skip-reduced]
    spark-submit tessera/jobs.py reduce --parquet <imported> --reduced <out> [--columns <dir>]

Each step prints one JSON summary line. A missing input exits with status 1.
The casts map composed column names to Spark types, e.g.
``{"Reference - PMID": "int", "Reference - Date": "smallint"}``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):  # run as a script (spark-submit tessera/jobs.py): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _session() -> SparkSession:
    from tessera.session import get_session

    return get_session(app_name="tessera-jobs")


def run_import(spark: SparkSession, src: str, parquet: str, casts: dict[str, str] | None = None,
               columns: str | None = None, multiline: bool = True) -> dict:
    from tessera.sinks.convert import convert_to_parquet
    from tessera.sinks.writers import write_catalog_json
    from tessera.sources.sharded_csv import describe_source

    if columns:
        write_catalog_json(describe_source(spark, src, casts), columns, document=True)
    summary = convert_to_parquet(spark, src, parquet, casts, multiline=multiline).first().asDict()
    return {"step": "import", **summary}


def run_reduce(spark: SparkSession, parquet: str, reduced: str, columns: str | None = None) -> dict:
    from tessera.operators.catalog import describe_table
    from tessera.operators.reduce import extract_fields, reduce_to_grain
    from tessera.operators.reports import reduced_summary
    from tessera.sinks.writers import write_catalog_json, write_reduced_table

    table = write_reduced_table(reduce_to_grain(extract_fields(spark.read.parquet(parquet))), reduced)
    if columns:
        write_catalog_json(describe_table(table), columns, document=True)
    return {"step": "reduce", **reduced_summary(table).first().asDict()}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera.jobs")
    sub = parser.add_subparsers(dest="command", required=True)
    imp = sub.add_parser("import", help="sharded CSV export -> typed Parquet (then the reduced table)")
    imp.add_argument("--input", required=True)
    imp.add_argument("--parquet", required=True)
    imp.add_argument("--casts", help="JSON map of composed column name -> Spark type; by default the export's own types")
    imp.add_argument("--multiline", action=argparse.BooleanOptionalAction, default=True,
                     help="whether quoted fields may hold line breaks; without, large shards are read in splits")
    imp.add_argument("--columns", help="folder for the column catalog document")
    imp.add_argument("--reduced", help="also build the reduced table here")
    imp.add_argument("--reduced-columns", help="folder for the reduced table's catalog document")
    imp.add_argument("--skip-reduced", action="store_true")
    red = sub.add_parser("reduce", help="imported Parquet -> reduced table")
    red.add_argument("--parquet", required=True)
    red.add_argument("--reduced", required=True)
    red.add_argument("--columns", help="folder for the reduced table's catalog document")
    args = parser.parse_args(argv)

    spark = spark or _session()
    from tessera.session import path_exists

    try:
        if args.command == "import":
            if not path_exists(spark, args.input):
                raise FileNotFoundError(f"{args.input} not found")
            print(json.dumps(run_import(
                spark, args.input, args.parquet, json.loads(args.casts) if args.casts else None, args.columns, args.multiline)))
            if args.reduced and not args.skip_reduced:
                print(json.dumps(run_reduce(spark, args.parquet, args.reduced, args.reduced_columns)))
        else:
            if not path_exists(spark, args.parquet):
                raise FileNotFoundError(f"nothing is imported at {args.parquet} yet")
            print(json.dumps(run_reduce(spark, args.parquet, args.reduced, args.columns)))
    except FileNotFoundError as err:
        print(f"error: {err}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
