"""Approximate aggregates as sketches kept by day and merged when read.

``daily_sketches`` stores for each day and place a sketch of the distinct bills (HyperLogLog with
2^``LOG2_K`` registers) and one of the line amounts (KLL with ``KLL_K``), of at most a few
kilobytes each, however many lines the day had. Days of several batches may be appended.
A question about any set of days and coarser places merges the sketches of the days
alone; the lines are not read again.

Errors: the distinct count has a relative standard error of 1.04 / sqrt(2^LOG2_K), and its
``bound`` is three of these; a quantile is off in rank by at most ``RANK_BOUND`` (99 %
confidence at this KLL_K, doubled for one side). Reports give the bound beside the estimate.

Defined results: null bills and amounts are in no sketch; a place with none gives 0 and null; a
null place is a group of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG2_K, KLL_K = 12, 400
RELATIVE_BOUND = 3 * 1.04 / math.sqrt(1 << LOG2_K)
RANK_BOUND = 0.0133


def daily_sketches(sales: DataFrame, places: tuple[str, ...] | list[str]) -> DataFrame:
    """``sale_date, *places, bills, amounts``: one row per day and place."""
    return sales.groupBy("sale_date", *places).agg(
        F.hll_sketch_agg("bill_no", LOG2_K).alias("bills"), F.kll_sketch_agg_bigint("amount", KLL_K).alias("amounts")
    )


def merged_bills(sketches: DataFrame, by: tuple[str, ...] | list[str]) -> DataFrame:
    """``*by, bills, bound``: estimated distinct bills, and how far off the estimate may be."""
    merged = sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("bills")).alias("bills"))
    return merged.withColumn("bound", F.ceil(F.col("bills") * RELATIVE_BOUND))


def merged_quantiles(sketches: DataFrame, by: tuple[str, ...] | list[str], shares: tuple[float, ...]) -> DataFrame:
    """``*by, quantiles``: the amounts below which the ``shares`` of the lines are."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("amounts", KLL_K).alias("amounts"))
    at = F.array(*(F.lit(float(s)) for s in shares))
    return merged.select(*by, F.kll_sketch_get_quantile_bigint("amounts", at).alias("quantiles"))
