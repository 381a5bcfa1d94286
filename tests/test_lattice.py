"""Reports from stored aggregates and from mergeable day states."""

from __future__ import annotations

import datetime as dt

import pytest
from compare import normalised_rows
from frames import frame, sale
from pyspark.sql import functions as F

from tillroll.operators.averages import avg_per_day
from tillroll.operators.day_state import as_bitmap, avg_per_day_of_state, days_of, merge_states, trading_state
from tillroll.plans.inspect import plan_summary, plan_text
from tillroll.plans.lattice import NODE_OF, NODES, answer, line_of, node_rows, read_node, store_lattice
from tillroll.plans.reports import GEO, REP, REPORTS
from tillroll.plans.run import run_all
from tillroll.sources import read_sales_fact, write_sales_fact


def rows(df):
    return normalised_rows(df.columns, [tuple(r) for r in df.collect()])


@pytest.fixture(scope="module")
def stored(spark, oracle_sales, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lattice"))
    fact = read_sales_fact(spark, write_sales_fact(oracle_sales, f"{root}/fact"))
    store_lattice(fact, f"{root}/nodes")
    return fact, f"{root}/nodes"


@pytest.mark.parametrize("report", list(NODE_OF))
def test_answers_equal_the_reports(spark, stored, report):
    fact, folder = stored
    got = answer(spark, folder, report, "1998")
    # The fact is not read, the excluded year is not read, and nothing is joined.
    assert all(f"/nodes/{NODE_OF[report]}/" in f for f in got.inputFiles())
    plan = plan_text(got)
    assert "sale_year" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert plan_summary(got)["joins"] == 0 and plan_summary(got)["exchanges"] <= 1
    assert rows(got) == rows(REPORTS[report].run(fact, "1998"))


def test_seventeen_reports_from_three_scans_of_the_fact():
    from_fact = [n for n in NODES.values() if n.parent is None]
    assert len(from_fact) == 3 and len(NODE_OF) == 17
    assert all(line_of(n)[0] in {x.name for x in from_fact} for n in NODES)


def test_children_read_their_parents(spark, stored):
    _, folder = stored
    for node in NODES.values():
        if node.parent:
            child = node_rows(read_node(spark, folder, node.parent), node.name)
            assert all(f"/nodes/{node.parent}/" in f for f in child.inputFiles())
            assert set(node.dims) <= set(NODES[node.parent].dims)


EDGES = [
    sale(quantity=5, amount=0), sale(quantity=-5, amount=0), sale(quantity=0, amount=0, category="only zero"),
    sale(quantity=None, amount=3, category="none"), sale(sale_date="", category="undated"),
    sale(sale_date="02-11-2017 10:15", quantity=2), sale(sale_date="02-11-2016", quantity=9),
    sale(source_site="", quantity=1), sale(zone=None, quantity=4), sale(rep_id=None), sale(sub_category=""),
    sale(quantity=7, amount=-7, category="cancels"), sale(quantity=-7, amount=7, category="cancels"),
]


@pytest.mark.parametrize("report", list(NODE_OF))
def test_zero_lines_empty_fields_and_dates(spark, scratch, report):
    lines = frame(spark, *EDGES)
    folder = f"{scratch}/nodes"
    store_lattice(lines, folder, [NODE_OF[report]])
    assert rows(answer(spark, folder, report)) == rows(REPORTS[report].run(lines))


def test_an_appended_batch_adds_up(spark, scratch):
    folder = f"{scratch}/nodes"
    names = ["category", "month", "person_place"]
    store_lattice(frame(spark, *EDGES[:5]), folder, names)
    store_lattice(frame(spark, *EDGES[5:]), folder, names, mode="append")
    lines = frame(spark, *EDGES)
    for name in names:
        for report in NODES[name].answers:
            assert rows(answer(spark, folder, report)) == rows(REPORTS[report].run(lines))


def test_unreadable_fields_fail_the_reports_that_read_them(spark, scratch):
    lines = frame(spark, sale(quantity=1), sale(amount=None, bad_fields=",amount,"))
    folder = f"{scratch}/nodes"
    store_lattice(lines, folder)
    assert rows(answer(spark, folder, "category_quantity")) == rows(REPORTS["category_quantity"].run(lines))
    with pytest.raises(Exception, match="unreadable amount"):
        answer(spark, folder, "daily_value").collect()


def test_no_rows_and_unknown_reports(spark, scratch):
    folder = f"{scratch}/nodes"
    store_lattice(frame(spark), folder, ["category"])
    assert answer(spark, folder, "category_quantity").count() == 0
    with pytest.raises(ValueError):
        answer(spark, folder, "item_ranking")


def test_run_all_from_the_lattice(spark, scratch):
    lines = frame(spark, *EDGES)
    names = ["category_quantity", "daily_value", "rep_catalog"]
    ts = dt.datetime(2026, 1, 2)
    plain = run_all(lines, f"{scratch}/plain", names, run_ts=ts)
    stored_ = run_all(lines, f"{scratch}/stored", names, run_ts=ts, lattice=True)
    for name in names:
        assert rows(spark.read.parquet(stored_[name])) == rows(spark.read.parquet(plain[name]))


# Day states

DATED = [
    sale(pos_code=f"P{i % 3}", sale_date=f"{1 + i * 7 % 28:02d}-{1 + i % 12:02d}-{1969 + i % 60}", rep_id=f"R{i % 5}", quantity=i)
    for i in range(200)
] + [
    sale(sale_date="05-05-2017 10:15"), sale(sale_date="05-05-2017 11:15"), sale(sale_date="05-05-2017"),
    sale(sale_date="31-12-1969"), sale(sale_date="01-01-1970"), sale(quantity=-3), sale(pos_code=None),
]


@pytest.mark.parametrize("dims, mode", [((), "int"), (("city", "state", "zone"), "int"), (REP, "float")])
def test_averages_of_states(spark, dims, mode):
    lines = frame(spark, *DATED)
    state = trading_state(lines, dims)
    expected = rows(avg_per_day(lines.where("pos_code is not null"), dims, mode))
    assert rows(avg_per_day_of_state(state, dims, mode)) == expected
    # States of batches merge, and those of finer dims serve coarser ones.
    part = F.pmod(F.hash("sale_date"), F.lit(3))
    batches = [trading_state(lines.where(part == i), (*dims, "bill_no")) for i in range(3)]
    merged = merge_states(batches[0].unionByName(batches[1]).unionByName(batches[2]), dims)
    assert rows(merged) == rows(state)
    assert rows(avg_per_day_of_state(merged, dims, mode)) == expected


def test_days_equal_the_distinct_count(spark, oracle_sales):
    exact = oracle_sales.groupBy("pos_code", "source_site").agg(F.countDistinct("sale_date").alias("days"))
    state = trading_state(oracle_sales, GEO[1:])
    assert rows(days_of(state)) == rows(exact)
    bitmaps = as_bitmap(state).groupBy("pos_code", "source_site").agg(F.sum(F.bitmap_count("days")).alias("days"))
    assert rows(bitmaps) == rows(exact)


def test_a_state_is_one_scan_and_one_shuffle(stored):
    fact, _ = stored
    state = trading_state(REPORTS["rep_avg_quantity_per_day"].rows(fact, "1998"), REP)
    summary = plan_summary(state)
    assert summary["scans"] == 1 and summary["exchanges"] == 1 and summary["joins"] == 0
    assert "HashAggregate" in plan_text(state) and "ObjectHashAggregate" not in plan_text(state)
