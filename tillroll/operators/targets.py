"""O11: point-of-sale target totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pos_target_sum(sales: DataFrame, alias: str = "TargetSum") -> DataFrame:
    """O11: ``sum(pos_target)`` per (source_site, pos_target)."""
    return sales.groupBy("source_site", "pos_target").agg(F.sum("pos_target").alias(alias))
