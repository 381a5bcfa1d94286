"""O9 within groups: the n items with the most sale lines of every place.

Lines are counted per (place, item) first, map-side combined. The rank filter then becomes
Spark's group limit: each task keeps the n first items of each place before the
shuffle (``WindowGroupLimit``, Partial), so a place that holds a third of all items sends n rows
per task to the one that ranks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.ranking import RANK_KEY

TIES = ("key", "all")


def top_items_by(
    sales: DataFrame, places: tuple[str, ...] | list[str], n: int = 10, ties: str = "key", alias: str = "Quantity"
) -> DataFrame:
    """``*places, rank, sub_category, item_code, item_attr, <alias>``.

    ``ties="key"``: items with equal counts are ordered by their key, so every place has
    at most ``n`` rows. ``ties="all"``: they share a rank, and all items that tie with the
    last are kept. Null places are a group of their own."""
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}, got {ties!r}")
    if not places:
        raise ValueError("at least one place column; top_items ranks all items")
    counted = sales.groupBy(*places, *RANK_KEY).agg(F.count(F.lit(1)).alias(alias))
    by_count = Window.partitionBy(*places)
    if ties == "key":
        rank = F.row_number().over(by_count.orderBy(F.desc(alias), *RANK_KEY))
    else:
        rank = F.rank().over(by_count.orderBy(F.desc(alias)))
    ranked = counted.withColumn("rank", rank).where(F.col("rank") <= n)
    return ranked.select(*places, "rank", *RANK_KEY, alias)
