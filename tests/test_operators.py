"""Operator unit tests on literal frames: one per rule of the source reports."""

from __future__ import annotations

import pytest
from frames import frame, rows_of, sale

from tillroll.operators import (
    avg_per_day,
    daily_category_scorecard,
    dimension_catalog,
    exclude_year,
    measure_by,
    mobile_completeness,
    monthly_by_quarter,
    pos_target_sum,
    require_non_empty,
    top_items,
)


def test_exclude_year_drops_only_that_year(spark):
    df = frame(
        spark,
        sale(sale_date="01-01-2016"),
        sale(sale_date="31-12-2016"),
        sale(sale_date="01-01-2017"),
        sale(sale_date="05-06-2015"),
    )
    kept = exclude_year(df, "2016")
    assert rows_of(kept, "sale_date") == [("01-01-2017",), ("05-06-2015",)]


def test_exclude_year_without_year_column_reads_date_text(spark):
    df = frame(spark, sale(sale_date="01-01-2016"), sale(sale_date="02-01-2017")).drop("sale_year")
    assert rows_of(exclude_year(df, "2016"), "sale_date") == [("02-01-2017",)]


def test_require_non_empty_strings_and_measures(spark):
    df = frame(
        spark,
        sale(bill_no="ok"),
        sale(bill_no="no-promo", promo_name=""),
        sale(bill_no="no-qty", quantity=None),
        sale(bill_no="zero-qty", quantity=0),
    )
    kept = require_non_empty(df, ("promo_name", "quantity"))
    assert rows_of(kept, "bill_no") == [("ok",), ("zero-qty",)]
    assert require_non_empty(df, ()).count() == 4


def test_zero_policy_none_keeps_zero_groups(spark):
    df = frame(spark, sale(category="A", quantity=0), sale(category="B", quantity=2))
    out = measure_by(df, ["category"], "quantity", "none", "q")
    assert rows_of(out, "category", "q") == [("A", 0), ("B", 2)]


def test_zero_policy_rows_drops_zero_lines_before_sum(spark):
    df = frame(
        spark,
        sale(category="A", quantity=0),
        sale(category="B", quantity=0),
        sale(category="B", quantity=3),
    )
    out = measure_by(df, ["category"], "quantity", "rows", "q")
    # A had only zero lines, so it disappears; B keeps its non-zero line.
    assert rows_of(out, "category", "q") == [("B", 3)]


def test_zero_policy_rows_keeps_groups_that_cancel(spark):
    df = frame(spark, sale(category="A", amount=5), sale(category="A", amount=-5))
    out = measure_by(df, ["category"], "amount", "rows", "a")
    assert rows_of(out, "category", "a") == [("A", 0)]


def test_zero_policy_groups_drops_groups_summing_to_zero(spark):
    df = frame(
        spark,
        sale(category="A", amount=5),
        sale(category="A", amount=-5),
        sale(category="B", amount=0),
        sale(category="C", amount=7),
    )
    out = measure_by(df, ["category"], "amount", "groups", "a")
    assert rows_of(out, "category", "a") == [("C", 7)]


def test_zero_policy_rejects_unknown(spark):
    df = frame(spark, sale())
    with pytest.raises(ValueError):
        measure_by(df, ["category"], "amount", "some", "a")


def test_monthly_by_quarter_labels_each_month_and_returns_text(spark):
    rows = [sale(sale_date=f"15-{m:02d}-2017", quantity=m) for m in range(1, 13)]
    rows.append(sale(sale_date="01-03-2018", quantity=100))  # same month, other year
    out = monthly_by_quarter(frame(spark, *rows), "quantity", "Quantity")
    got = sorted((r["Quarter"], r["Quantity"]) for r in out.collect())
    expected = sorted(
        [("Qtr1", "1"), ("Qtr1", "2"), ("Qtr1", "103"), ("Qtr2", "4"), ("Qtr2", "5"), ("Qtr2", "6"),
         ("Qtr3", "7"), ("Qtr3", "8"), ("Qtr3", "9"), ("Qtr4", "10"), ("Qtr4", "11"), ("Qtr4", "12")]
    )
    assert got == expected
    assert dict(out.dtypes)["Quantity"] == "string"


def test_avg_per_day_int_truncates(spark):
    df = frame(
        spark,
        sale(sale_date="01-01-2017", quantity=4),
        sale(sale_date="02-01-2017", quantity=3),
        sale(sale_date="02-01-2017", quantity=0),
    )
    out = avg_per_day(df, (), "int", "r")
    assert rows_of(out, "pos_code", "source_site", "r") == [("P1", "S1", 3)]  # 7 div 2
    assert dict(out.dtypes)["r"] == "bigint"


def test_avg_per_day_days_counted_per_site_not_per_dims(spark):
    # Rep R1 sold on one day, R2 on another; the site traded on two days, so
    # each rep's quantity is divided by 2.
    df = frame(
        spark,
        sale(rep_id="R1", sale_date="01-01-2017", quantity=5),
        sale(rep_id="R2", sale_date="02-01-2017", quantity=6),
    )
    out = avg_per_day(df, ("rep_id",), "float", "r")
    assert rows_of(out, "rep_id", "r") == [("R1", 2.5), ("R2", 3.0)]
    assert dict(out.dtypes)["r"] == "float"
    as_int = avg_per_day(df, ("rep_id",), "int", "r")
    assert rows_of(as_int, "rep_id", "r") == [("R1", 2), ("R2", 3)]


def test_avg_per_day_float_is_32_bit(spark):
    df = frame(
        spark,
        sale(sale_date="01-01-2017", quantity=1),
        sale(sale_date="02-01-2017", quantity=0),
        sale(sale_date="03-01-2017", quantity=0),
    )
    (value,) = rows_of(avg_per_day(df, ("rep_id",), "float", "r"), "r")[0]
    import numpy as np

    assert value == pytest.approx(float(np.float32(1) / np.float32(3)), rel=0, abs=1e-9)


def test_mobile_completeness_counts_distinct_bills_by_label(spark):
    df = frame(
        spark,
        sale(bill_no="1", customer_mobile="9" * 10),
        sale(bill_no="1", customer_mobile="9" * 10),  # duplicate line of one bill
        sale(bill_no="2", customer_mobile="9" * 11),
        sale(bill_no="3", customer_mobile="9" * 12),
        sale(bill_no="4", customer_mobile="9" * 9),
        sale(bill_no="5", customer_mobile="9" * 13),
        sale(bill_no="6", customer_mobile=""),
    )
    out = mobile_completeness(df, ())
    assert rows_of(out, "CustomerMobile", "Count") == [("No", 3), ("Yes", 3)]


def test_mobile_completeness_by_dims(spark):
    df = frame(
        spark,
        sale(bill_no="1", zone="Z1", customer_mobile="9" * 10),
        sale(bill_no="1", zone="Z2", customer_mobile="9" * 10),
        sale(bill_no="2", zone="Z1", customer_mobile=""),
    )
    out = mobile_completeness(df, ("zone",))
    assert rows_of(out, "zone", "CustomerMobile", "Count") == [
        ("Z1", "No", 1), ("Z1", "Yes", 1), ("Z2", "Yes", 1)
    ]


def test_scorecard_any_valid_mobile_and_constant_count(spark):
    df = frame(
        spark,
        sale(category="C", sub_category="S", bill_no="1", customer_mobile="", quantity=2, amount=10),
        sale(category="C", sub_category="S", bill_no="2", customer_mobile="9" * 10, quantity=3, amount=20),
        sale(category="D", sub_category="S", bill_no="3", customer_mobile="123", quantity=1, amount=5),
    )
    out = daily_category_scorecard(df)
    got = rows_of(out, "Category", "Quantity", "Amount", "CustomerMobile", "Count")
    assert got == [("C", "5", "30", "Yes", "1"), ("D", "1", "5", "No", "1")]
    import datetime as dt

    assert {r["date"] for r in out.collect()} == {dt.date(2017, 1, 1)}


def test_top_items_counts_lines_not_quantity_and_hides_attr(spark):
    df = frame(
        spark,
        sale(item_code="I1", item_attr="A", quantity=100),
        sale(item_code="I2", item_attr="A", quantity=1),
        sale(item_code="I2", item_attr="A", quantity=1),
        sale(item_code="I2", item_attr="B", quantity=1),
    )
    out = top_items(df)
    got = [(r["item_code"], r["Quantity"]) for r in out.collect()]
    # Ordered by count desc; ties by key. I2 appears twice (attrs A and B).
    assert got == [("I2", 2), ("I1", 1), ("I2", 1)]
    assert out.columns == ["sub_category", "item_code", "Quantity"]
    assert [(r["item_code"], r["Quantity"]) for r in top_items(df, n=1).collect()] == [("I2", 2)]


def test_dimension_catalog_is_distinct(spark):
    df = frame(spark, sale(zone="Z1"), sale(zone="Z1"), sale(zone="Z2"))
    assert rows_of(dimension_catalog(df, ("zone", "state"))) == [("Z1", "St1"), ("Z2", "St1")]


def test_pos_target_sum_per_site_and_target(spark):
    df = frame(
        spark,
        sale(source_site="S1", pos_target=10),
        sale(source_site="S1", pos_target=10),
        sale(source_site="S1", pos_target=20),
        sale(source_site="S2", pos_target=-3),
    )
    out = pos_target_sum(df, "t")
    assert rows_of(out, "source_site", "pos_target", "t") == [
        ("S1", 10, 20), ("S1", 20, 20), ("S2", -3, -3)
    ]


def test_monthly_by_quarter_rollup_sums_each_quarter(spark):
    rows = [sale(sale_date=f"15-{m:02d}-2017", quantity=m) for m in range(1, 13)]
    out = monthly_by_quarter(frame(spark, *rows), "quantity", "Quantity", rollup=True)
    assert rows_of(out, "Quarter", "Quantity") == [
        ("Qtr1", "6"), ("Qtr2", "15"), ("Qtr3", "24"), ("Qtr4", "33")
    ]


def test_top_items_with_n_plans_a_top_k(spark):
    from tillroll.plans.inspect import plan_text

    df = frame(spark, *[sale(item_code=f"I{i % 5}") for i in range(20)])
    plan = plan_text(top_items(df, n=3), "simple")
    assert "TakeOrderedAndProject" in plan
    assert "TakeOrderedAndProject" not in plan_text(top_items(df), "simple")
