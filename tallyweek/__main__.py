"""Command line: ``python -m tallyweek <report> [seasons] --input <landed tables> --output <folder>``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tallyweek.checks import distinct_players
from tallyweek.reports import REPORTS, land_facts, matrix_tables, publish_report, read_weekly_report
from tallyweek.session import tune
from tallyweek.sinks.publish import export_season_file
from tallyweek.sources.landed import parse_seasons


def parser() -> argparse.ArgumentParser:
    parse = argparse.ArgumentParser(prog="tallyweek", description="Weekly player reports")
    parse.add_argument("report", choices=[*REPORTS, "matrix", "facts"])
    parse.add_argument("seasons", nargs="?", default="2024", help="all, a year, or comma-separated years")
    parse.add_argument("-i", "--input", required=True, help="landed tables, or the written weekly report for matrix")
    parse.add_argument("-o", "--output", default="./reports")
    parse.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parse.add_argument("--single-files", action="store_true", help="csv: also one file per season, for small seasons")
    parse.add_argument("--scoring", help="weights document for the opportunity report")
    parse.add_argument("--facts", help="opportunity: a folder that the facts command wrote")
    parse.add_argument("--min-games", type=int, default=3, help="matrix: least number of games of a player")
    return parse


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = tune(SparkSession.builder.appName("tallyweek").getOrCreate())
    if args.report == "matrix":
        report = read_weekly_report(spark, args.input, args.format)
        for name, df in matrix_tables(report, args.min_games).items():
            df.write.mode("overwrite").parquet(f"{args.output}/{name}")
        order = spark.read.parquet(f"{args.output}/player_order")
        print(f"{distinct_players(order)} players")
        return 0
    if args.report == "facts":
        return 0 if land_facts(spark, args.input, args.output) else 1
    options = {"scoring": args.scoring, "facts": args.facts} if args.report == "opportunity" else {}
    run = publish_report(
        spark, args.report, args.input, parse_seasons(args.seasons), args.output, args.format, **options
    )
    if run is None:
        print("No report: a required table has no rows.")
        return 1
    for stage, rows in run.stages.items():
        print(f"{stage}: {rows} rows")
    for season, rows in sorted(run.seasons.items(), key=str):
        print(f"season {season}: {rows} rows published")
    if args.single_files and args.format == "csv":
        report = REPORTS[args.report]
        for season in run.seasons:
            print(export_season_file(spark, f"{args.output}/{report.name}", season, run.schema, report.sort))
    return 0


if __name__ == "__main__":
    sys.exit(main())
