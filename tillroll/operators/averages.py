"""O6: average quantity sold per trading day.

The denominator is always the number of distinct sale dates of a
(pos_code, source_site) pair, even when the sums are finer (per rep, or per
city/state/zone). Two aggregates and one equi-join:

* ``days``: ``count(distinct sale_date)`` per pair. Spark plans it as a
  partial aggregate on (pair, date) first, so a hot pair shrinks to one row per
  date before the shuffle.
* ``totals``: ``sum(quantity)`` per (pair, dims), map-side combined.
* ``totals`` join ``days`` on the pair: ``days`` has one row per pair. No
  broadcast hint: AQE broadcasts ``days`` when its measured size is under the
  threshold; otherwise a sort-merge join runs.
* Skew: a pair holding a large share of the rows can have very many dimension
  combinations, and all of them would meet in one join task. AQE splits such a
  task only if both sides come straight from a shuffle made for the join. The
  aggregate's own partitioning would serve ``days``, so the join key also holds
  a hash of the pair: both sides are then shuffled for the join, and AQE splits
  the hot partition of ``totals`` and reads that of ``days`` (one row per pair)
  once per split. Pairs that are not hot are neither copied nor salted.

Without extra dims both measures come from one aggregate and no join is
needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import float_ratio, int_ratio

SITE_KEY = ("pos_code", "source_site")
RATIO_MODES = ("int", "float")
JOIN_HASH = "pair_hash"


def _ratio(mode: str):
    if mode not in RATIO_MODES:
        raise ValueError(f"mode must be one of {RATIO_MODES}, got {mode!r}")
    return int_ratio("qty", "days") if mode == "int" else float_ratio("qty", "days")


def avg_per_day(
    sales: DataFrame,
    dims: list[str] | tuple[str, ...] = (),
    mode: str = "int",
    alias: str = "QtnPerDay",
) -> DataFrame:
    """O6: columns ``pos_code, source_site, *dims, <alias>``."""
    ratio = _ratio(mode)
    if not dims:
        both = sales.groupBy(*SITE_KEY).agg(
            F.sum("quantity").alias("qty"), F.countDistinct("sale_date").alias("days")
        )
        return both.select(*SITE_KEY, ratio.alias(alias))
    days = sales.groupBy(*SITE_KEY).agg(F.countDistinct("sale_date").alias("days"))
    totals = sales.groupBy(*SITE_KEY, *dims).agg(F.sum("quantity").alias("qty"))
    pair = F.xxhash64(*SITE_KEY)
    joined = totals.withColumn(JOIN_HASH, pair).join(
        days.withColumn(JOIN_HASH, pair), [*SITE_KEY, JOIN_HASH], "inner"
    )
    return joined.select(*SITE_KEY, *dims, ratio.alias(alias))
