"""O9: item ranking by number of sale lines.

The ranking counts rows (never sums quantity) per
(sub_category, item_code, item_attr, *dims) and sorts by that count,
descending. ``item_attr`` is part of the key but not of the output, so an
(sub_category, item_code) pair can appear more than once. The source has no
row limit despite its "top 10" names; ``n`` is optional.

Ties are broken by the key columns, which makes the sort key unique: the range
partitioner of the global sort then splits evenly even when most groups share
the same count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANK_KEY = ("sub_category", "item_code", "item_attr")


def top_items(
    sales: DataFrame,
    dims: list[str] | tuple[str, ...] = (),
    n: int | None = None,
    alias: str = "Quantity",
) -> DataFrame:
    """O9: columns ``sub_category, item_code, *dims, <alias>`` in ranking order."""
    keys = [*RANK_KEY, *dims]
    counted = sales.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
    ordered = counted.orderBy(F.col(alias).desc(), *keys)
    if n is not None:
        ordered = ordered.limit(n)
    return ordered.select("sub_category", "item_code", *dims, alias)
