"""Streaming reports equal the batch report over the same files."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from compare import normalised_rows
from frames import frame, sale
from pyspark.sql import functions as F

from tillroll.plans.reports import REPORTS
from tillroll.sources import header_line, read_sales_text, to_sales_lines
from tillroll.streaming import STREAMABLE, start_report_stream


def _drop(spark, df, folder, name):
    """Write one text file (header + lines) into the watched folder."""
    lines = [header_line()] + [r["value"] for r in to_sales_lines(df).collect()]
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _latest(spark, sink):
    out = spark.read.parquet(sink)
    last = out.agg(F.max("batch_id")).first()[0]
    return out.filter(F.col("batch_id") == last).drop("TimeStamp", "batch_id")


def _same(a, b):
    return normalised_rows(a.columns, [tuple(r) for r in a.collect()]) == normalised_rows(
        b.columns, [tuple(r) for r in b.collect()]
    )


@pytest.mark.parametrize("name", ["rep_daily_value", "quarter_quantity", "daily_category_scorecard"])
def test_stream_matches_batch_after_each_drop(spark, scratch, name):
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    os.makedirs(source)
    first = frame(
        spark,
        sale(sale_date="01-01-2017", amount=10, quantity=1, bill_no="1"),
        sale(sale_date="01-01-2017", amount=-10, quantity=2, bill_no="2", customer_mobile=""),
        sale(sale_date="02-03-2017", amount=5, quantity=3, item_code="I2"),
        sale(sale_date="02-03-2016", amount=7, quantity=4),
    )
    second = frame(
        spark,
        sale(sale_date="01-01-2017", amount=4, quantity=5, category="C2"),
        sale(sale_date="03-11-2017", amount=6, quantity=6, item_code="I2"),
    )
    _drop(spark, first, source, "a.csv")
    q = start_report_stream(spark, source, name, sink, ckpt, excluded_year="2016",
                            output_mode="complete", available_now=True)
    q.awaitTermination(120)
    batch = REPORTS[name].run(read_sales_text(spark, source, header=header_line()), "2016")
    assert _same(_latest(spark, sink), batch)

    _drop(spark, second, source, "b.csv")
    q = start_report_stream(spark, source, name, sink, ckpt, excluded_year="2016",
                            output_mode="complete", available_now=True)
    q.awaitTermination(120)
    batch = REPORTS[name].run(read_sales_text(spark, source, header=header_line()), "2016")
    assert _same(_latest(spark, sink), batch)


def test_replayed_batch_is_not_duplicated(spark, scratch):
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    os.makedirs(source)
    _drop(spark, frame(spark, sale(amount=3), sale(amount=4, sale_date="02-01-2017")), source, "a.csv")
    q = start_report_stream(spark, source, "daily_value", sink, ckpt, available_now=True)
    q.awaitTermination(120)
    first = spark.read.parquet(sink).count()
    # Simulate a replay of batch 0: drop the commit record, restart from the checkpoint.
    for name in ("0", ".0.crc"):
        path = os.path.join(ckpt, "commits", name)
        if os.path.exists(path):
            os.remove(path)
    q = start_report_stream(spark, source, "daily_value", sink, ckpt, available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.count() == first == 2
    assert {r["batch_id"] for r in out.select("batch_id").collect()} == {0}


def test_backlog_in_several_triggers_gives_the_batch_result(spark, scratch):
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    os.makedirs(source)
    for i in range(3):
        _drop(spark, frame(spark, sale(amount=10 + i, sale_date=f"0{i + 1}-01-2017")), source, f"{i}.csv")
    q = start_report_stream(spark, source, "daily_value", sink, ckpt, available_now=True,
                            output_mode="complete", max_files_per_trigger=1)
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert {r["batch_id"] for r in out.select("batch_id").distinct().collect()} == {0, 1, 2}
    batch = REPORTS["daily_value"].run(read_sales_text(spark, source, header=header_line()))
    assert _same(_latest(spark, sink), batch)


def test_a_stable_checkpoint_is_required(spark, scratch):
    if spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        pytest.skip("the session has a shared folder")
    with pytest.raises(ValueError, match="checkpoint"):
        start_report_stream(spark, scratch, "daily_value", os.path.join(scratch, "out"), available_now=True)


RESTART = """
import sys
sys.path[:0] = [{root!r}]
from pyspark.sql import SparkSession
from tillroll.streaming import start_report_stream
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {ckpt!r}).getOrCreate())
start_report_stream(spark, {source!r}, "daily_value", {sink!r}, available_now=True).awaitTermination(120)
"""


def test_restart_in_another_session_resumes(spark, scratch):
    source, sink, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "shared"))
    os.makedirs(source)
    script = RESTART.format(root=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                            ckpt=ckpt, source=source, sink=sink)
    for k, row in enumerate((sale(amount=3), sale(amount=4, sale_date="02-01-2017"))):
        _drop(spark, frame(spark, row), source, f"{k}.csv")
        subprocess.run([sys.executable, "-c", script], check=True, timeout=240)
    out = spark.read.parquet(sink)
    # The second process read the new file only, in a new batch.
    got = {(r["batch_id"], r["Amount"]) for r in out.collect()}
    assert got == {(0, 3), (1, 4)}


def test_non_streamable_report_is_refused(spark, scratch):
    for name in ("avg_quantity_per_day", "item_ranking"):
        with pytest.raises(ValueError):
            start_report_stream(spark, scratch, name, scratch, scratch)


def test_streamable_names_exist():
    assert set(STREAMABLE) <= set(REPORTS)
