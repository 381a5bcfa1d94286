"""Fused plans equal the source's branch-and-join forms; finer reports add up
to coarser ones (sf0.01 sale lines)."""

from __future__ import annotations

from compare import normalised_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import day_of, mobile_filled
from tillroll.operators import avg_per_day, daily_category_scorecard, exclude_year
from tillroll.plans.reports import REPORTS

YEAR = "1998"


def _same(a, b):
    return normalised_rows(a.columns, [tuple(r) for r in a.collect()]) == normalised_rows(
        b.columns, [tuple(r) for r in b.collect()]
    )


def test_scorecard_fused_equals_three_join_form(oracle_sales):
    rows = exclude_year(oracle_sales, YEAR)
    key = ["sale_date", "category", "sub_category"]
    qty = rows.groupBy(*key).agg(F.sum("quantity").alias("q"))
    amt = rows.groupBy(*key).agg(F.sum("amount").alias("a"))
    flags = (
        rows.select(*key, "bill_no", "customer_mobile").distinct()
        .withColumn("f", mobile_filled("customer_mobile").cast("int"))
        .groupBy(*key).agg(F.sum("f").alias("s"))
        .withColumn("m", F.when(F.col("s") >= 1, "Yes").otherwise("No"))
    )
    counts = flags.groupBy(*key, "m").count()
    joined = qty.join(amt, key).join(counts, key)
    three_join = joined.select(
        day_of("sale_date").alias("date"), F.col("category").alias("Category"),
        F.col("sub_category").alias("SubCategory"),
        F.col("q").cast(T.StringType()).alias("Quantity"),
        F.col("a").cast(T.StringType()).alias("Amount"),
        F.col("m").alias("CustomerMobile"), F.col("count").cast(T.StringType()).alias("Count"),
    )
    assert _same(daily_category_scorecard(rows), three_join)


def test_avg_per_day_without_dims_equals_join_form(oracle_sales):
    rows = exclude_year(oracle_sales, YEAR)
    fused = avg_per_day(rows, (), "int", "r")
    site = ["pos_code", "source_site"]
    days = rows.select("pos_code", "sale_date", "source_site").distinct().groupBy(*site).count()
    totals = rows.groupBy(*site).agg(F.sum("quantity").alias("q"))
    joined = days.join(totals, site).select(*site, F.expr("q div count").alias("r"))
    assert _same(fused, joined)


def _total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_finer_sums_add_up_to_coarser(oracle_sales):
    run = {n: r.run(oracle_sales, YEAR) for n, r in REPORTS.items()}
    daily = _total(run["daily_quantity"], "Count")
    assert _total(run["zone_daily_quantity"], "Count") == daily
    assert _total(run["rep_daily_quantity"].filter("PromoName <> ''"), "Count") <= daily
    assert sum(int(r["Quantity"]) for r in run["quarter_quantity"].collect()) == daily
    assert sum(int(r["Amount"]) for r in run["quarter_value"].collect()) == _total(
        run["daily_value"], "Amount"
    )
    assert _total(run["zone_category_quantity"], "Quantity") == _total(
        run["category_quantity"], "Quantity"
    )
    assert _total(run["zone_salesperson_value"], "Amount") == _total(
        run["salesperson_value"], "Amount"
    )
    scorecard = run["daily_category_scorecard"].agg(
        F.sum(F.col("Quantity").cast("bigint")).alias("q")
    ).first()["q"]
    assert scorecard == daily


def test_ranking_counts_every_kept_line(oracle_sales):
    ranked = REPORTS["item_ranking"].run(oracle_sales, YEAR)
    kept = REPORTS["item_ranking"].rows(oracle_sales, YEAR).count()
    assert _total(ranked, "Quantity") == kept
    counts = [r["Quantity"] for r in ranked.collect()]
    assert counts == sorted(counts, reverse=True)


def test_mobile_counts_cover_every_distinct_bill_number_pair(oracle_sales):
    out = REPORTS["mobile_completeness"].run(oracle_sales, YEAR)
    pairs = exclude_year(oracle_sales, YEAR).select("bill_no", "customer_mobile").distinct().count()
    assert _total(out, "Count") == pairs
