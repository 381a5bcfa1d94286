"""O7 and O8: how often a customer mobile number was captured.

A number counts as filled in when its length is 10, 11 or 12.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import day_of, mobile_filled, mobile_label
from tillroll.schema import SCORECARD_COUNT


def mobile_completeness(
    sales: DataFrame, dims: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """O7: distinct (bill, dims, mobile), labelled Yes/No, counted per (dims, label).

    Output: ``*dims, CustomerMobile, Count``. Two map-side-combined aggregates
    (the distinct, then the count); the distinct is hashed on the bill number
    too, so a dimension value holding many bills spreads over many tasks.
    """
    distinct_bills = sales.select("bill_no", *dims, "customer_mobile").distinct()
    labelled = distinct_bills.select(
        *dims, mobile_label(mobile_filled("customer_mobile")).alias("CustomerMobile")
    )
    return labelled.groupBy(*dims, "CustomerMobile").agg(F.count(F.lit(1)).alias("Count"))


def daily_category_scorecard(sales: DataFrame) -> DataFrame:
    """O8: per (date, category, sub-category): quantity and amount sums, whether any
    line carried a filled-in mobile, and a constant count of ``"1"``.

    One aggregate replaces the source's three joined branches: every branch has
    the same key set, so joining them on the key is the same as computing the
    three measures in one pass. Measures are returned as text.
    """
    g = sales.groupBy("sale_date", "category", "sub_category").agg(
        F.sum("quantity").alias("qty"),
        F.sum("amount").alias("amt"),
        F.bool_or(mobile_filled("customer_mobile")).alias("any_mobile"),
    )
    return g.select(
        day_of("sale_date").alias("date"),
        F.col("category").alias("Category"),
        F.col("sub_category").alias("SubCategory"),
        F.col("qty").cast(T.StringType()).alias("Quantity"),
        F.col("amt").cast(T.StringType()).alias("Amount"),
        mobile_label("any_mobile").alias("CustomerMobile"),
        F.lit(SCORECARD_COUNT).alias("Count"),
    )
