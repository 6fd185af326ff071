"""Command line: deduplicate, enrich, convert-libraries, report-jobs."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tagloom.operators.counts import deduplicate
from tagloom.operators.enrich import enrichment, observed_blocks
from tagloom.plans.jobs_report import report_jobs
from tagloom.plans.libraries import convert_folder, load_config
from tagloom.session import clear_work
from tagloom.sources.sinks import write_table
from tagloom.sources.tables import read_building_blocks, read_counts


def _arguments(argv):
    parser = argparse.ArgumentParser(prog="tagloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("deduplicate", "enrich"):
        p = commands.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--data-dir", help="folder with building_blocks/; without it, enrich takes the blocks that are counted")
        p.add_argument("--selection-id", default="selection")
    p = commands.add_parser("convert-libraries")
    p.add_argument("--input-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--config", required=True)
    p = commands.add_parser("report-jobs")
    p.add_argument("--log", required=True)
    p.add_argument("--usage", help="captured accounting output")
    p.add_argument("--requested", help="CSV with process, cpus, memory, time")
    p.add_argument("--output")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _arguments(argv)
    spark = spark or SparkSession.builder.appName(f"tagloom-{args.command}").getOrCreate()
    if args.command in ("deduplicate", "enrich"):
        counts = deduplicate(read_counts(spark, args.input, args.selection_id))
        if args.command == "enrich":
            blocks = read_building_blocks(spark, f"{args.data_dir}/building_blocks") if args.data_dir else observed_blocks(counts)
            counts = enrichment(counts, blocks)
        write_table(counts, args.output)
        clear_work(spark)
        return 0
    if args.command == "convert-libraries":
        verdicts, totals = convert_folder(spark, args.input_dir, args.output_dir, load_config(args.config))
        # One row per vendor file.
        for row in verdicts.orderBy("file").toLocalIterator():
            print(*row, sep="\t")
        return 1 if totals.first().failed else 0
    requested = None
    if args.requested:
        requested = spark.read.csv(args.requested, header=True)
    jobs, summary, status = report_jobs(spark, args.log, args.usage, requested, args.output)
    status.show()
    for row in summary.orderBy("process").toLocalIterator():
        print(*row, sep="\t")
    return 0 if jobs.limit(1).count() else 1


if __name__ == "__main__":
    sys.exit(main())
