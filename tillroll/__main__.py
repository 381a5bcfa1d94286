"""Command line: run reports over a sales input and append them to a sink.

    python -m tillroll --text 'hdfs:///sales/*.csv' --sink hdfs:///reports
    python -m tillroll --tables /data/tpch --sink /out --reports daily_quantity,pos_target
    python -m tillroll --list

The session comes from the launcher (``spark-submit`` settings); only the
recommended SQL settings are added.
"""

from __future__ import annotations

import argparse
import sys

from tillroll.plans.reports import RANKINGS, REPORTS
from tillroll.plans.run import run_all
from tillroll.schema import DEFAULT_EXCLUDED_YEAR
from tillroll.session import build_session, configured_shared_dir
from tillroll.sources.tables import sales_from_tables
from tillroll.sources.sink import write_report
from tillroll.sources.text import first_line, parse_sales_lines, rejected_lines


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tillroll", description=__doc__.split("\n")[0])
    source = p.add_mutually_exclusive_group()
    source.add_argument("--text", help="raw sales text file(s) or folder")
    source.add_argument("--tables", help="folder of star-schema parquet tables")
    p.add_argument("--sink", help="root folder/URI; each report goes to <sink>/<name>/run_id=<id>")
    p.add_argument("--reports", help="comma-separated report names (default: all)")
    p.add_argument("--excluded-year", default=DEFAULT_EXCLUDED_YEAR)
    p.add_argument("--mode", choices=("strict", "lenient"), default="strict")
    p.add_argument("--header", help="header line of the text input (default: its first line)")
    p.add_argument("--format", default="parquet", help="sink writer format")
    p.add_argument(
        "--option", action="append", default=[], metavar="KEY=VALUE",
        help="sink writer option, {report} stands for the report's name; without --sink the format is "
        "addressed by options alone and every report is appended",
    )
    p.add_argument("--shared-dir", help="folder that driver and executors share, used where spark.checkpoint.dir is unset")
    p.add_argument("--keep-fact", action="store_true", help="keep the written sale lines after the run")
    p.add_argument("--top", type=int, help="first rows of the item rankings only (default: all)")
    p.add_argument("--fact-path", help="where to write the typed sale lines (default: shared folder)")
    p.add_argument("--parallel", type=int, default=4, help="report jobs submitted at once (default 4)")
    p.add_argument("--rejects", help="with --text: also write unreadable lines (value, reason) here")
    p.add_argument("--row-id", help="field for ids that a retry makes again, for stores that replace documents by id")
    p.add_argument("--lattice", action="store_true", help="answer sum reports from stored aggregates (three scans of the lines)")
    p.add_argument("--list", action="store_true", help="list report names and exit")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.list:
        for name, report in REPORTS.items():
            print(f"{name}\t{report.description}")
        return 0
    if not (args.text or args.tables) or not (args.sink or args.option):
        _parser().error("give --text or --tables, and --sink or --option")
    if not all("=" in o for o in args.option):
        _parser().error("--option needs KEY=VALUE")
    names = args.reports.split(",") if args.reports else list(REPORTS)
    unknown = [n for n in names if n not in REPORTS]
    if unknown:
        _parser().error(f"unknown reports: {', '.join(unknown)}")
    if args.rejects and not args.text:
        _parser().error("--rejects needs --text")
    spark = build_session(app_name="tillroll-reports")
    if args.shared_dir and not configured_shared_dir(spark):
        spark.sparkContext.setCheckpointDir(args.shared_dir)
    if args.text:
        lines = spark.read.text(args.text)
        header = args.header or first_line(lines)
        sales = parse_sales_lines(lines, header, args.mode)
        if args.rejects:
            write_report(rejected_lines(lines, header), args.rejects, fmt=args.format)
        if args.mode == "lenient":
            print(f"rejected lines\t{rejected_lines(lines, header).count()}")
    else:
        sales = sales_from_tables(spark, args.tables)
    targets = run_all(
        sales, args.sink, names, args.excluded_year, args.fact_path, args.format,
        parallelism=args.parallel, options=dict(o.split("=", 1) for o in args.option),
        keep_fact=args.keep_fact, limits=dict.fromkeys(RANKINGS, args.top) if args.top else None,
        lattice=args.lattice, row_id=args.row_id,
    )
    for name, target in targets.items():
        print(f"{name}\t{target or args.format}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
