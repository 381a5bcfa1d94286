"""Every report against an independent DuckDB statement on the same tables (sf0.01)."""

from __future__ import annotations

import pytest
from compare import compare

import __spark_entry__ as entry
from tillroll.plans.reports import REPORTS

SQL = entry.oracle_sql()


def test_every_report_has_a_query_and_an_oracle():
    names = set(REPORTS) | set(OTHERS)
    assert names <= set(entry.queries()) and names <= set(SQL) <= set(entry.queries())


OTHERS = ["parsed_sales_lines", "text_daily_quantity", "text_headed_daily_value", "stamped_daily_quantity"] + [
    f"fact_{name}" for name in ("daily_category_scorecard", "rep_avg_quantity_per_day", "zone_mobile_completeness", "rep_daily_value")
]


@pytest.mark.parametrize("name", OTHERS)
def test_other_paths_match_oracle(spark, duck, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.01")
    assert compare(df, duck, SQL[name]) is None


@pytest.mark.parametrize("name", list(REPORTS))
def test_report_matches_oracle(name, oracle_sales, duck):
    df = REPORTS[name].run(oracle_sales, entry.CHECK_YEAR)
    assert compare(df, duck, SQL[name]) is None


def test_query_entry_point_matches_oracle(spark, duck):
    df = entry.queries()["rep_daily_value"](spark, "/root/testdata/sf0.01")
    assert compare(df, duck, SQL["rep_daily_value"]) is None


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "date", "Category", "SubCategory", "Quantity", "Amount", "CustomerMobile", "Count"
    ]
    assert df.count() > 0
