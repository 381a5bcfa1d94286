"""Plan shape guards: pruning, pushdown and shuffle counts over the written fact."""

from __future__ import annotations

import pytest

from tillroll.plans.inspect import plan_summary, scan_digest
from tillroll.plans.reports import REPORTS
from tillroll.schema import SALES_COLUMNS
from tillroll.sources import read_sales_fact, write_sales_fact

# Most shuffles a report may need (the initial plan; AQE only removes some).
MAX_EXCHANGES = {
    "avg_quantity_per_day": 2,
    "zone_avg_quantity_per_day": 5,
    "rep_avg_quantity_per_day": 5,
    "mobile_completeness": 2,
    "zone_mobile_completeness": 2,
    "rep_mobile_completeness": 2,
    "item_ranking": 2,
    "zone_item_ranking": 2,
}


@pytest.fixture(scope="module")
def fact(spark, oracle_sales, tmp_path_factory):
    return read_sales_fact(spark, write_sales_fact(oracle_sales, str(tmp_path_factory.mktemp("f") / "fact")))


@pytest.mark.parametrize("name", list(REPORTS))
def test_report_plan_prunes_pushes_and_bounds_shuffles(name, fact):
    report = REPORTS[name]
    df = report.run(fact, "1998")
    summary = plan_summary(df)
    assert summary["exchanges"] <= MAX_EXCHANGES.get(name, 1)
    for scan in scan_digest(df):
        read = scan["ReadSchema"]
        assert read.count(":") < len(SALES_COLUMNS) - 1  # never every column
        if report.year_rule:
            assert "sale_year" in scan["PartitionFilters"] and "1998" in scan["PartitionFilters"]
        for col in report.non_empty:
            assert f"IsNotNull({col})" in scan["PushedFilters"]


def test_scorecard_has_no_join(fact):
    summary = plan_summary(REPORTS["daily_category_scorecard"].run(fact, "1998"))
    assert summary["joins"] == 0 and summary["exchanges"] == 1
