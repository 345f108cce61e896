"""Jobs for ``spark-submit``, one sub-command each.

    spark-submit main.py --root hdfs:///lake load landing.csv
    spark-submit main.py --root hdfs:///lake month 2001-05 2001-06 --explain
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from monthlake.months import BatchMonth
from monthlake.operators import TEXT_ORDER, time_order, word_count
from monthlake.plans import (
    CURATED_TABLE,
    build_source,
    explain_month,
    list_partitions,
    process_months,
    process_raw_months,
    profile_csv,
    register_curated,
    require_months,
    require_sound,
    slice_months_raw,
    verify_content,
    verify_lake,
    verify_month,
    verify_raw_month,
    verify_source,
)
from monthlake.sinks import print_rows, write_raw_months, write_report_csv
from monthlake.sources import read_incidents_csv, read_lines, read_source
from monthlake.zones import Zones


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="monthlake")
    top.add_argument("--root", help="folder of the lake's zones")
    jobs = top.add_subparsers(dest="job", required=True)

    load = jobs.add_parser("load", help="CSV to the partitioned source")
    load.add_argument("csv")
    load.add_argument("--multi-line", action="store_true", help="fields may hold line breaks")
    load.add_argument("--mode", choices=["rebuild", "partitions"], default="rebuild")

    month = jobs.add_parser("month", help="process months of the source")
    month.add_argument("months", nargs="+", type=BatchMonth.parse)
    month.add_argument("--explain", action="store_true", help="show the pruned scan")

    raw = jobs.add_parser("raw-month", help="process months straight from the CSV")
    raw.add_argument("csv")
    raw.add_argument("months", nargs="+", type=BatchMonth.parse)
    raw.add_argument("--multi-line", action="store_true", help="fields may hold line breaks")
    for job in (month, raw):
        job.add_argument("--order", choices=["text", "time"], default="text", help="which row of an ID is first")

    raw_check = jobs.add_parser("verify-raw", help="check months processed from the CSV")
    raw_check.add_argument("months", nargs="+", type=BatchMonth.parse)

    for name, text in (("register", "make curated months visible in SQL"),
                       ("verify", "check all months, or the ones given"),
                       ("verify-source", "rows per month of the source")):
        job = jobs.add_parser(name, help=text)
        if name != "verify-source":
            job.add_argument("--table", default=CURATED_TABLE)
        if name == "verify":
            job.add_argument("months", nargs="*", type=BatchMonth.parse)
            job.add_argument("--content", action="store_true", help="compare the rows themselves, not only their counts")

    sql = jobs.add_parser("sql", help="run a query on the registered table")
    sql.add_argument("query")
    sql.add_argument("--table", default=CURATED_TABLE)
    sql.add_argument("--rows", type=int, help="print only so many")

    words = jobs.add_parser("words", help="count the words of text files")
    words.add_argument("text")
    words.add_argument("output")
    words.add_argument("--parts", action="store_true", help="several files, not one")
    words.add_argument("--rows", type=int, help="print only so many")

    profile = jobs.add_parser("profile", help="schema, size and first rows of CSV files")
    profile.add_argument("csv")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "words":
        counts = word_count(read_lines(spark, args.text))
        order = [F.desc("count"), "word"]
        write_report_csv(counts, args.output, single_file=not args.parts, order=order)
        written = spark.read.schema(counts.schema).option("header", True).csv(args.output)
        print_rows(written.orderBy(*order), args.rows)
        return
    if args.job == "profile":
        profile = profile_csv(spark, args.csv)
        for part in (profile.columns, profile.total, profile.preview):
            print_rows(part)
        return

    if args.root is None:
        raise SystemExit(f"{args.job} needs --root")
    zones = Zones(args.root)
    if args.job == "load":
        rows = read_incidents_csv(spark, args.csv, multiLine=args.multi_line)
        print(build_source(rows, zones, args.mode))
        months = list_partitions(read_source(spark, zones))
        for year, month in months.toLocalIterator():
            print(f"year={year}/month={month}")
    elif args.job == "month":
        require_months(spark, zones, args.months)
        if args.explain:
            for month in args.months:
                print_rows(explain_month(spark, zones, month))
        order = time_order() if args.order == "time" else TEXT_ORDER
        print_rows(process_months(spark, zones, args.months, order=order))
    elif args.job == "raw-month":
        rows = slice_months_raw(read_incidents_csv(spark, args.csv, multiLine=args.multi_line), args.months)
        write_raw_months(rows, zones, args.months)
        order = time_order() if args.order == "time" else TEXT_ORDER
        print_rows(process_raw_months(spark, zones, args.months, order=order))
    elif args.job == "verify-raw":
        for month in args.months:
            print_rows(verify_raw_month(spark, zones, month))
    elif args.job == "register":
        register_curated(spark, zones, args.table)
    elif args.job == "verify":
        register_curated(spark, zones, args.table)
        for month in args.months:
            print_rows(verify_month(spark, zones, month, args.table))
        if not args.months:
            lines = verify_lake(spark, zones, args.table).collect()  # one per month
            schema = "batch_month string, raw bigint, curated bigint, rejected bigint, visible bigint, sound boolean"
            found = spark.createDataFrame(lines, schema)
            print_rows(found)
            require_sound(found)
        if args.content:
            print_rows(require_sound(verify_content(spark, zones, args.table)))
    elif args.job == "verify-source":
        print_rows(verify_source(spark, zones))
    elif args.job == "sql":
        register_curated(spark, zones, args.table)
        print_rows(spark.sql(args.query), args.rows)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = (
        SparkSession.builder.appName(f"monthlake-{args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    run(spark, args)
