"""O4 and O5: sums of a measure by dimensions.

All sums are map-side combined (partial + final ``HashAggregate``), so a key
holding a large share of the rows costs one partial row per input task before
the shuffle, never a hot task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import month_text, quarter_label

ZERO_POLICIES = ("none", "rows", "groups")


def nonzero_lines(measure: str) -> str:
    """The column of partial sums that counts the lines whose measure is not zero."""
    return f"{measure}_lines"


def measure_by(
    sales: DataFrame,
    dims: list[str] | tuple[str, ...],
    measure: str,
    zero_policy: str = "none",
    alias: str = "total",
) -> DataFrame:
    """O4: ``sum(measure)`` per combination of ``dims``.

    ``zero_policy``: ``none`` keeps everything; ``rows`` drops rows whose
    measure is 0 before summing; ``groups`` drops groups whose sum is 0. Rows of
    partial sums (``plans.lattice``) stand for lines of zero only if none of their lines
    is another, which they count beside the sum.
    """
    if zero_policy not in ZERO_POLICIES:
        raise ValueError(f"zero_policy must be one of {ZERO_POLICIES}, got {zero_policy!r}")
    counted = nonzero_lines(measure)
    asked = counted if counted in sales.columns else measure
    rows = sales.filter(F.col(asked) != 0) if zero_policy == "rows" else sales
    out = rows.groupBy(*dims).agg(F.sum(measure).alias(alias))
    if zero_policy == "groups":
        out = out.filter(F.col(alias) != 0)
    return out


def monthly_by_quarter(
    sales: DataFrame, measure: str, alias: str, rollup: bool = False
) -> DataFrame:
    """O5: one row per month number (all kept years together), labelled with its
    quarter; the sum is returned as text (``Quarter``, ``alias``).

    ``rollup=True`` sums the months of each quarter into one row instead (the
    source reports never do this; it is off by default).
    """
    by_month = sales.groupBy(month_text("sale_date").alias("sale_month")).agg(
        F.sum(measure).alias("total")
    )
    labelled = by_month.select(
        quarter_label(F.col("sale_month").cast(T.IntegerType())).alias("Quarter"), "total"
    )
    if rollup:
        labelled = labelled.groupBy("Quarter").agg(F.sum("total").alias("total"))
    return labelled.select("Quarter", F.col("total").cast(T.StringType()).alias(alias))
