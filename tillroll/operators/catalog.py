"""O10: distinct combinations of dimension columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dimension_catalog(sales: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """O10: ``select(columns).distinct()`` - a map-side-combined aggregate, so a
    combination repeated on a third of the rows collapses before the shuffle.
    """
    return sales.select(*columns).distinct()
