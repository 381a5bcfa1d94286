"""The command line over raw sales text, end to end."""

from __future__ import annotations

import os

from compare import normalised_rows
from pyspark.sql import functions as F

from tillroll.__main__ import main
from tillroll.plans.reports import REPORTS
from tillroll.sources import header_line, to_sales_lines


def test_cli_runs_reports_over_text(spark, oracle_sales, scratch, capsys):
    sample = oracle_sales.filter(F.col("bill_no").endswith("3"))
    text_dir = os.path.join(scratch, "text")
    os.makedirs(text_dir)
    lines = [r["value"] for r in to_sales_lines(sample).collect()]
    with open(os.path.join(text_dir, "sales.csv"), "w") as fh:
        fh.write("\n".join([header_line(), *lines]) + "\n")
    sink = os.path.join(scratch, "sink")
    names = ["daily_value", "zone_item_ranking", "rep_avg_quantity_per_day"]
    code = main(["--text", text_dir, "--sink", sink, "--reports", ",".join(names),
                 "--excluded-year", "1998", "--fact-path", os.path.join(scratch, "fact")])
    assert code == 0
    printed = capsys.readouterr().out
    for name in names:
        assert name in printed
        got = spark.read.parquet(os.path.join(sink, name)).drop("TimeStamp", "run_id")
        want = REPORTS[name].run(sample, "1998")
        assert normalised_rows(got.columns, [tuple(r) for r in got.collect()]) == normalised_rows(
            want.columns, [tuple(r) for r in want.collect()]
        )


def test_cli_lists_reports(capsys):
    assert main(["--list"]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == len(REPORTS)


def test_cli_writes_rejects_in_lenient_mode(spark, scratch):
    text_dir = os.path.join(scratch, "text")
    os.makedirs(text_dir)
    base = [""] * 15
    with open(os.path.join(text_dir, "sales.csv"), "w") as fh:
        fh.write("\n".join([
            header_line(),
            ",".join(["1", "01-02-2017"] + base + ["abc", "12"]),
            ",".join(["2", "02-02-2017"] + base + ["4", "5"]),
        ]) + "\n")
    rejects = os.path.join(scratch, "rejects")
    code = main(["--text", text_dir, "--sink", os.path.join(scratch, "sink"), "--mode", "lenient",
                 "--reports", "daily_value", "--rejects", rejects, "--excluded-year", "2016",
                 "--fact-path", os.path.join(scratch, "fact")])
    assert code == 0
    got = [(r["reason"]) for r in spark.read.parquet(rejects).collect()]
    assert got == ["quantity is not a number"]
