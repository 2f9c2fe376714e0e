"""Jobs for spark-submit: ``python -m gridloom.jobs <job> ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from gridloom.operators.rollup import average_by_metric, metrics_detail, metrics_line, total_records
from gridloom.plans.ingest import load_new_zips, load_workbook_files
from gridloom.plans.workloads import run_workloads
from gridloom.sources.tables import METRICS, create_tables, register_folders
from gridloom.streaming.arrivals import load_arrivals

REPORTS = {
    "total": total_records,
    "average": average_by_metric,
    "detail": metrics_detail,
    "line": metrics_line,
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gridloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--schema", required=True, help="schema, with its catalog if there is more than one")
        return sub

    job("create", "create or update the tables").add_argument("--location")
    job("register", "register table folders").add_argument("--warehouse", required=True)
    job("ingest", "load new zips under a prefix").add_argument("--prefix", required=True)
    watch = job("watch", "load zips as they arrive")
    watch.add_argument("--prefix", required=True)
    watch.add_argument("--checkpoint", required=True)
    watch.add_argument("--forever", action="store_true")
    files = job("ingest-file", "load workbooks that are not in a zip")
    files.add_argument("--prefix", required=True)
    files.add_argument("--zip-name", default="placeholder.zip")
    job("workloads", "run the workloads, one metric row each")
    job("report", "show a roll-up of the metrics").add_argument("--kind", choices=REPORTS, default="detail")
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"gridloom-{args.job}").getOrCreate()
    if args.job == "register":
        print(", ".join(register_folders(spark, args.schema, args.warehouse)))
        return
    create_tables(spark, args.schema, location=getattr(args, "location", None))
    if args.job == "ingest":
        print(load_new_zips(spark, args.schema, args.prefix))
    elif args.job == "watch":
        load_arrivals(spark, args.schema, args.prefix, args.checkpoint, not args.forever).awaitTermination()
    elif args.job == "ingest-file":
        print(load_workbook_files(spark, args.schema, args.prefix, args.zip_name))
    elif args.job == "workloads":
        print(run_workloads(spark, args.schema))
    elif args.job == "report":
        REPORTS[args.kind](spark.table(f"{args.schema}.{METRICS}")).show(truncate=False)


if __name__ == "__main__":
    main()
