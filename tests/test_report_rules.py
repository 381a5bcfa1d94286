
from __future__ import annotations

import pytest
from frames import frame, sale
from pyspark.sql import functions as F

from tillroll.plans.reports import REPORTS

DATE, QTY, AMT = "sale_date", "quantity", "amount"
GEO = ("source_site", "city", "state", "zone")
REP = ("rep_id", "rep_name", "promo_name", "category")

# name -> (fields that must be present, year rule applies)
RULES = {
    "daily_quantity": ({DATE, QTY}, True),
    "daily_value": ({DATE, AMT}, True),
    "quarter_quantity": ({DATE, QTY}, True),
    "quarter_value": ({DATE, AMT}, True),
    "category_quantity": ({DATE, "category", QTY}, True),
    "subcategory_quantity": ({DATE, "sub_category", QTY}, True),
    "salesperson_quantity": ({"source_site", "rep_id", "rep_name", QTY, "city", DATE}, True),
    "salesperson_value": ({"source_site", "rep_id", "rep_name", AMT, "city", DATE}, True),
    "avg_quantity_per_day": ({"pos_code", DATE, "source_site", QTY}, True),
    "zone_avg_quantity_per_day": ({"pos_code", DATE, QTY, *GEO}, True),
    "rep_avg_quantity_per_day": ({"pos_code", DATE, "source_site", QTY, *REP}, True),
    "mobile_completeness": (set(), True),
    "zone_mobile_completeness": (set(), True),
    "rep_mobile_completeness": (set(), True),
    "daily_category_scorecard": (set(), True),
    "pos_target": ({"source_site", "pos_target", "field_28", DATE}, True),
    "item_ranking": ({DATE, "sub_category", "item_code", "item_attr"}, True),
    "zone_item_ranking": ({DATE, "sub_category", "item_code", "item_attr", *GEO}, True),
    "rep_catalog": ({*REP, DATE}, True),
    "site_catalog": (set(), False),
    "site_category_catalog": ({*GEO, "category"}, False),
    "site_promo_catalog": ({"promo_name"}, False),
    "site_rep_catalog": (set(), True),
    "zone_daily_quantity": ({DATE, QTY, *GEO}, True),
    "zone_daily_value": ({DATE, AMT, *GEO}, True),
    "zone_category_quantity": ({DATE, "category", QTY, *GEO}, True),
    "zone_subcategory_quantity": ({DATE, "sub_category", AMT, *GEO}, True),
    "zone_salesperson_quantity": ({"rep_id", "rep_name", QTY, DATE, *GEO}, True),
    "zone_salesperson_value": ({"rep_id", "rep_name", AMT, DATE, *GEO}, True),
    "rep_daily_quantity": ({DATE, QTY, *REP}, True),
    "rep_daily_value": ({DATE, AMT, *REP}, True),
    "rep_contribution_value": ({"source_site", AMT, DATE, "city", *REP}, True),
    "rep_contribution_quantity": ({"source_site", QTY, DATE, "city", *REP}, True),
    "rep_category_quantity": ({DATE, QTY, *REP}, True),
    "rep_subcategory_quantity": ({DATE, "measure_19", "sub_category", *REP}, True),
}


def test_every_report_has_its_rules():
    assert set(RULES) == set(REPORTS)
    for name, (fields, year_rule) in RULES.items():
        assert set(REPORTS[name].non_empty) == fields, name
        assert REPORTS[name].year_rule is year_rule, name


@pytest.mark.parametrize("name", list(REPORTS))
def test_rules_act_on_lines(spark, name):
    fields, year_rule = RULES[name]
    report = REPORTS[name]
    base = sale(sale_date="01-01-2017")
    variants = {"kept": base, "excluded year": sale(sale_date="01-01-2016")}
    for f in fields:
        row = dict(base)
        row[f] = None if f in (QTY, AMT, "measure_19", "pos_target") else ""
        if f == DATE:
            row["sale_year"] = None
        variants[f"empty {f}"] = row
    for label, row in variants.items():
        kept = report.rows(frame(spark, row), "2016").count()
        if label == "kept":
            assert kept == 1
        elif label == "excluded year":
            assert kept == (0 if year_rule else 1)
        else:
            assert kept == 0, label


# the sum, "groups" drops zero sums after it. The others keep both.
POLICIES = {
    "category_quantity": (QTY, "rows"),
    "subcategory_quantity": (QTY, "rows"),
    "salesperson_quantity": (QTY, "rows"),
    "salesperson_value": (AMT, "rows"),
    "zone_category_quantity": (QTY, "rows"),
    "zone_subcategory_quantity": (AMT, "rows"),
    "zone_salesperson_quantity": (QTY, "rows"),
    "zone_salesperson_value": (AMT, "rows"),
    "rep_daily_value": (AMT, "groups"),
    "rep_contribution_value": (AMT, "rows"),
    "rep_contribution_quantity": (QTY, "rows"),
    "rep_category_quantity": (QTY, "rows"),
    "rep_subcategory_quantity": ("measure_19", "rows"),
    "daily_quantity": (QTY, "none"),
    "daily_value": (AMT, "none"),
    "zone_daily_quantity": (QTY, "none"),
    "zone_daily_value": (AMT, "none"),
    "rep_daily_quantity": (QTY, "none"),
}


@pytest.mark.parametrize("name", list(POLICIES))
def test_zero_policy_acts_on_lines(spark, name):
    measure, policy = POLICIES[name]
    report = REPORTS[name]

    def groups(*values):
        return report.run(frame(spark, *(sale(**{measure: v}) for v in values)), "2016").count()

    assert groups(5, -3) == 1
    assert groups(0) == (1 if policy == "none" else 0)
    assert groups(4, -4) == (0 if policy == "groups" else 1)


@pytest.mark.parametrize("name", [n for n, (_, p) in POLICIES.items() if p != "none"])
def test_zero_policy_matters_in_the_checked_tables(oracle_sales, name):
    """The tables hold groups that the policy drops, so the comparison with SQL sees it."""
    measure, policy = POLICIES[name]
    rows = REPORTS[name].rows(oracle_sales, "1998")
    dims = [c for c in rows.columns if c in DIMS[name]]
    sums = rows.groupBy(*dims).agg(F.sum(measure).alias("s"), F.max(F.abs(measure)).alias("m"))
    assert sums.where("m = 0" if policy == "rows" else "s = 0").count() > 0


DIMS = {
    "category_quantity": ("category",),
    "subcategory_quantity": ("sub_category",),
    "salesperson_quantity": ("source_site", "rep_id", "rep_name", "city"),
    "salesperson_value": ("source_site", "rep_id", "rep_name", "city"),
    "zone_category_quantity": ("category", *GEO),
    "zone_subcategory_quantity": ("sub_category", *GEO),
    "zone_salesperson_quantity": ("rep_id", "rep_name", *GEO),
    "zone_salesperson_value": ("rep_id", "rep_name", *GEO),
    "rep_daily_value": (DATE, *REP),
    "rep_contribution_value": ("source_site", "city", *REP),
    "rep_contribution_quantity": ("source_site", "city", *REP),
    "rep_category_quantity": REP,
    "rep_subcategory_quantity": ("sub_category", *REP),
}
