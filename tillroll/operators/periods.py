"""Interval join: rows at a point of time with all periods that hold then.

An inequality join compares every row with every period. Here time is cut into bins and
the join is an equality on (key, level, bin), re-checked exactly. A period is put at the
lowest level whose bins are wide enough that it touches at most ``SPREAD`` + 1 of them
(bins grow by that factor from level to level), so a period of any length is a few rows;
a row is looked up once at each level. A key and bin that a third of all rows share
is split by the adaptive skew join; a row meets a period at most once, as the bins of a
level do not overlap.

Points and bounds are whole numbers or dates; both bounds belong to the period. Defined
results: rows and periods with a null key, point or bound match nothing, and so does a
period that ends before it begins; repeated rows and periods all match; an empty side
gives no rows. Period columns get ``prefix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Growth of the bins from level to level.
SPREAD = 8


def _number(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.DateType):
        return F.unix_date(column).cast("bigint")
    return F.col(column).cast("bigint")


def _bin(number: Column, width: int) -> Column:
    return F.floor(number / F.lit(width))


def join_periods(
    rows: DataFrame, periods: DataFrame, on: tuple[str, ...] | list[str], point: str, start: str, end: str,
    width: int = 16, levels: int = 5, prefix: str = "",
) -> DataFrame:
    """Every row with every period of its keys that contains its point: the columns of
    ``rows``, then those of ``periods`` but the keys. Beyond the last level periods touch
    as many bins as they take."""
    keys = [f"key_{i}" for i in range(len(on))]
    key_of = [F.col(c).alias(k) for c, k in zip(on, keys, strict=True)]
    widths = [width * SPREAD**i for i in range(levels)]

    held = periods.select(
        *key_of, F.struct(*(c for c in periods.columns if c not in on)).alias("period"),
        _number(periods, start).alias("first"), _number(periods, end).alias("last"),
    ).where("first <= last")
    level = F.lit(levels - 1)
    for i in reversed(range(levels - 1)):
        level = F.when(F.col("last") - F.col("first") < widths[i] * SPREAD, F.lit(i)).otherwise(level)
    bins = F.lit(None)
    for i, w in enumerate(widths):
        bins = F.when(F.col("level") == i, F.sequence(_bin(F.col("first"), w), _bin(F.col("last"), w))).otherwise(bins)
    held = held.withColumn("level", level).withColumn("bin", F.explode(bins))

    places = F.array(*(
        F.struct(F.lit(i).alias("level"), _bin(F.col("point"), w).alias("bin")) for i, w in enumerate(widths)
    ))
    asked = rows.select(*key_of, F.struct(*rows.columns).alias("row"), _number(rows, point).alias("point"))
    asked = asked.where("point is not null").select(*keys, "row", "point", F.inline(places))
    joined = asked.join(held, [*keys, "level", "bin"]).where("first <= point and point <= last")
    names = [c for c in periods.columns if c not in on]
    return joined.select("row.*", *(F.col(f"period.{c}").alias(f"{prefix}{c}") for c in names))
