"""Sale lines dealt anew between the joins and an aggregate with about one group per line."""

from __future__ import annotations

import pytest
from compare import compare
from frames import frame, rows_of, sale

import __spark_entry__ as entry
from tillroll.plans.inspect import plan_text
from tillroll.sources.tables import spread_lines

SF = "/root/testdata/sf0.01"


def test_spread_lines_are_the_same_lines(spark):
    rows = frame(spark, *[sale(bill_no=str(i % 5), item_code=str(i % 3)) for i in range(90)], sale(bill_no=None), sale(item_code=None))
    assert rows.exceptAll(spread_lines(rows)).count() == 0 == spread_lines(rows).exceptAll(rows).count()


def test_zones_meet_their_estimates_without_a_shuffle_by_zone(spark, duck):
    df = entry.queries()["sketched_zones"](spark, SF)
    plan = plan_text(df)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "BroadcastHashJoin" in plan
    # By zone alone only groups are dealt: to be joined, lines would be sorted by it.
    assert "Sort [zone" not in plan_text(df, "simple")
    assert compare(df, duck, entry.oracle_sql()["sketched_zones"]) is None


@pytest.mark.parametrize("name", ["zone_item_ranking", "item_ranking", "top_items_by_site", "top_items_by_zone", "zone_mobile_completeness", "mobile_completeness", "rep_mobile_completeness"])
def test_lines_are_dealt_anew_before_many_groups(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    plan = plan_text(df)
    assert plan.count("REBALANCE_PARTITIONS_BY_COL") == 1 and plan.count("ENSURE_REQUIREMENTS") > 1
    assert compare(df, duck, entry.oracle_sql()[name]) is None
