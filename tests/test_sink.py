"""O12 and the multi-report run."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

import pytest
from compare import normalised_rows
from frames import frame, sale
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tillroll.plans import REPORTS, run_all
from tillroll.sources import read_sales_fact, write_report, write_sales_fact


def test_write_report_appends_with_one_timestamp(spark, oracle_sales, scratch):
    target = os.path.join(scratch, "daily")
    report = REPORTS["daily_quantity"].run(oracle_sales, "1998")
    ts1 = write_report(report, target)
    ts2 = write_report(report, target)
    written = spark.read.parquet(target)
    assert written.columns[0] == "TimeStamp"
    assert written.count() == 2 * report.count()
    stamps = {r[0] for r in written.select("TimeStamp").distinct().collect()}
    assert stamps == {ts.replace(tzinfo=None) for ts in (ts1, ts2)}


def test_fact_is_partitioned_by_year_and_equal_to_input(spark, oracle_sales, scratch):
    path = write_sales_fact(oracle_sales, os.path.join(scratch, "fact"))
    years = sorted(d for d in os.listdir(path) if d.startswith("sale_year="))
    assert years == [f"sale_year={y}" for y in range(1995, 2002)]
    fact = read_sales_fact(spark, path)
    assert fact.columns == oracle_sales.columns
    assert fact.dtypes == oracle_sales.dtypes
    assert fact.exceptAll(oracle_sales).count() == 0 and oracle_sales.exceptAll(fact).count() == 0


def test_run_all_writes_every_report(spark, oracle_sales, scratch):
    names = ["daily_value", "rep_avg_quantity_per_day", "site_catalog", "zone_mobile_completeness"]
    targets = run_all(oracle_sales, os.path.join(scratch, "sink"), names, "1998",
                      fact_path=os.path.join(scratch, "fact"), parallelism=3)
    assert set(targets) == set(names)
    stamps = set()
    for name, target in targets.items():
        written = spark.read.parquet(target)
        stamps |= {r[0] for r in written.select("TimeStamp").distinct().collect()}
        expected = REPORTS[name].run(oracle_sales, "1998")
        got = written.drop("TimeStamp", "run_id")
        assert normalised_rows(got.columns, [tuple(r) for r in got.collect()]) == normalised_rows(
            expected.columns, [tuple(r) for r in expected.collect()]
        )
    assert len(stamps) == 1


def test_run_all_retry_replaces_and_runs_accumulate(spark, oracle_sales, scratch):
    from tillroll.sources import run_timestamp

    sink = os.path.join(scratch, "sink")
    names = ["quarter_quantity"]
    ts = run_timestamp()
    run_all(oracle_sales, sink, names, "1998", fact_path=os.path.join(scratch, "f1"), run_ts=ts)
    run_all(oracle_sales, sink, names, "1998", fact_path=os.path.join(scratch, "f2"), run_ts=ts)
    once = spark.read.parquet(os.path.join(sink, "quarter_quantity"))
    assert once.count() == 12  # the retried run replaced itself
    run_all(oracle_sales, sink, names, "1998", fact_path=os.path.join(scratch, "f3"))
    both = spark.read.parquet(os.path.join(sink, "quarter_quantity"))
    assert both.count() == 24 and both.select("run_id").distinct().count() == 2


def test_write_report_to_json(spark, oracle_sales, scratch):
    target = os.path.join(scratch, "json")
    report = REPORTS["quarter_value"].run(oracle_sales, "1998")
    write_report(report, target, fmt="json")
    back = spark.read.json(target)
    assert sorted(back.columns) == sorted(["TimeStamp", "Quarter", "Amount"])
    assert back.count() == 12


def test_write_report_without_a_path(spark, oracle_sales):
    # Formats addressed by options only (connectors) are saved without a path.
    report = REPORTS["site_catalog"].run(oracle_sales, "1998")
    ts = write_report(report, None, fmt="noop", mode="overwrite")
    assert ts is not None


def test_run_all_default_fact_path_follows_the_run(spark, oracle_sales, scratch):
    from tillroll.plans.run import run_id_of
    from tillroll.session import shared_dir
    from tillroll.sources import run_timestamp

    ts = run_timestamp()
    fact = f"{shared_dir(spark).rstrip('/')}/sales_fact-{run_id_of(ts)}"
    local = fact.removeprefix("file:")
    run_all(oracle_sales, os.path.join(scratch, "sink"), ["pos_target"], "1998", run_ts=ts, keep_fact=True)
    assert read_sales_fact(spark, fact).count() == oracle_sales.count()
    run_all(oracle_sales, os.path.join(scratch, "sink"), ["pos_target"], "1998", run_ts=ts)
    assert not os.path.exists(local)  # gone after success
    run_all(oracle_sales, os.path.join(scratch, "sink"), ["pos_target"], "1998", fact_path=f"{scratch}/own")
    assert os.path.exists(f"{scratch}/own")  # a given path stays


ZONES = """
import datetime as dt, sys, time
sys.path[:0] = [{root!r}]
from pyspark.sql import SparkSession, functions as F
from tillroll.sources.sink import run_timestamp, stamp
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", {session!r}).getOrCreate())
now = stamp(spark.range(1), run_timestamp()).select(F.unix_millis("TimeStamp")).first()[0]
assert abs(now / 1000 - time.time()) < 60, now
for zone in (None, dt.timezone.utc):
    fixed = stamp(spark.range(1), dt.datetime(2026, 1, 2, 3, 4, 5, 678000, zone))
    assert fixed.select(F.unix_millis("TimeStamp")).first()[0] == 1767323045678
"""


@pytest.mark.parametrize("zone,session", [("UTC", "UTC"), ("Asia/Kolkata", "UTC"), ("America/New_York", "Asia/Tokyo")])
def test_timestamp_is_the_instant_in_any_zone(zone, session):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = ZONES.format(root=root, session=session)
    subprocess.run([sys.executable, "-c", script], check=True, timeout=240, env=os.environ | {"TZ": zone})


class CollectionSource(DataSource):
    """A format that is addressed by options alone: appends rows to <folder>/<collection>."""

    @classmethod
    def name(cls):
        return "collections"

    def writer(self, schema, overwrite):
        return CollectionWriter(self.options, overwrite)


class CollectionWriter(DataSourceWriter):
    def __init__(self, options, overwrite):
        assert not overwrite, "a collection's history must not be replaced"
        self.target = f"{options['folder']}/{options['collection']}"

    def write(self, rows):
        lines = [str(r) for r in rows]
        with tempfile.NamedTemporaryFile("w", dir=self.target.rsplit("/", 1)[0], prefix=self.target.rsplit("/", 1)[1] + "-", delete=False) as f:
            f.write("\n".join(lines))
        return WriterCommitMessage()


def test_run_all_appends_to_collections_of_a_path_less_format(spark, oracle_sales, scratch):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(CollectionSource)
    names = ["quarter_quantity", "site_catalog"]
    for k in (1, 2):
        targets = run_all(oracle_sales, None, names, "1998", fact_path=os.path.join(scratch, "fact"), fmt="collections",
                          options={"folder": scratch, "collection": "{report}"})
        assert targets == {n: None for n in names}
        rows = [line for f in os.listdir(scratch) if f.startswith("quarter_quantity-")
                for line in open(os.path.join(scratch, f)).read().splitlines()]
        assert len(rows) == 12 * k  # runs accumulate


def test_rankings_can_be_cut(spark, oracle_sales, scratch):
    targets = run_all(oracle_sales, os.path.join(scratch, "sink"), ["item_ranking"], "1998",
                      fact_path=os.path.join(scratch, "fact"), limits={"item_ranking": 7})
    assert spark.read.parquet(targets["item_ranking"]).count() == 7


RETRIED = """
import json, os, sys
sys.path[:0] = [{root!r}]
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from tillroll.plans.reports import REPORTS
from tillroll.plans.run import run_all
from tillroll.schema import SALES_SCHEMA

class Store(DataSource):
    @classmethod
    def name(cls):
        return "documents"
    def writer(self, schema, overwrite):
        return Writer(self.options["folder"])

class Writer(DataSourceWriter):
    "A store without transactions that replaces documents by their id."
    def __init__(self, folder):
        self.folder = folder
    def write(self, rows):
        for i, row in enumerate(rows):
            if TaskContext.get().attemptNumber() < 2 and i == 1 + TaskContext.get().attemptNumber():
                raise RuntimeError("lost")
            with open(os.path.join(self.folder, row["_id"]), "w") as f:
                json.dump({{k: str(v) for k, v in row.asDict().items()}}, f)
        return WriterCommitMessage()

cloudpickle.register_pickle_by_value(sys.modules[__name__])
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "3").config("spark.sql.adaptive.enabled", "false")
         .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
spark.sparkContext.setLogLevel("OFF")
spark.dataSource.register(Store)
sales = spark.read.schema(SALES_SCHEMA).json({sales!r})
import datetime as dt
for _ in range(2):  # the run itself is retried, too
    run_all(sales, None, ["item_ranking"], fmt="documents", options={{"folder": {store!r}}}, row_id="_id",
            run_ts=dt.datetime(2026, 1, 2))
"""


def test_retried_tasks_and_runs_leave_every_row_once(spark, scratch):
    rows = [sale(item_code=f"I{i % 20}", item_attr=a) for i in range(60) for a in ("A", "B")]
    lines = frame(spark, *rows)
    lines.write.json(f"{scratch}/sales")
    os.makedirs(f"{scratch}/store")
    script = RETRIED.format(
        root=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), shared=f"{scratch}/shared",
        sales=f"{scratch}/sales", store=f"{scratch}/store",
    )
    subprocess.run([sys.executable, "-c", script], check=True, timeout=300)
    stored = [json.load(open(f"{scratch}/store/{f}")) for f in os.listdir(f"{scratch}/store")]
    expected = REPORTS["item_ranking"].run(lines)
    got = sorted((d["Item_Code"], d["SubCategory"], d["Quantity"]) for d in stored)
    assert got == sorted((r["Item_Code"], r["SubCategory"], str(r["Quantity"])) for r in expected.collect())
    assert len(got) == 40  # two equal rows of every item, with ids of their own
