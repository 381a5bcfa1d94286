"""As-of join: to each row the value in force at its time.

Of the figures with the row's key, the one with the latest time that is not after the row's
time holds. Rows and figures are put in one table, ordered by time, and the last figure
before a row is its value: one window instead of a join on an inequality.

So that a key with a third of all rows is no single task, the window's groups are
(key, stretch of ``width`` time units). A figure that holds beyond its stretch is carried: each
stretch starts with one row that has the last figure of the stretches before it, found
by a window over one row per (key, stretch). What is shuffled is each row once, and one
row for each stretch.

Times are whole numbers or dates. Defined results: rows without a figure in force, or with a
null key or time, come with nulls; figures with a null key or time hold nowhere; of
figures with the same key and time the greatest (by its columns, in order) holds; repeated
rows stay; row columns keep their names, figure columns get ``prefix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Order of what happens at one time in a stretch: what is carried in, figures, then rows.
CARRIED, FIGURE, ROW = 0, 1, 2


def _number(df: DataFrame, time: str) -> Column:
    """The time as a whole number (a date's day)."""
    if isinstance(df.schema[time].dataType, T.DateType):
        return F.unix_date(time).cast("bigint")
    return F.col(time).cast("bigint")


def asof_join(
    rows: DataFrame, figures: DataFrame, on: tuple[str, ...] | list[str], time: str, figure_time: str,
    values: tuple[str, ...] | list[str], width: int = 64, prefix: str = "",
) -> DataFrame:
    """``rows`` with the figure's time and ``values``; ``on`` are columns of both sides."""
    names = [figure_time, *values]
    keys = [f"key_{i}" for i in range(len(on))]
    key_of = [F.col(c).alias(k) for c, k in zip(on, keys, strict=True)]
    number = F.col("time_number")
    stretch = F.floor(number / width)
    held = figures.select(*key_of, F.struct(*names).alias("figure"), _number(figures, figure_time).alias("time_number"))
    held = held.where(" and ".join(f"{c} is not null" for c in [*keys, "time_number"]))
    # One figure for each key and time, so that what follows does not depend on an order.
    held = held.groupBy(*keys, "time_number").agg(F.max("figure").alias("figure")).withColumn("stretch", stretch)
    wanted = rows.select(*key_of, F.struct(*rows.columns).alias("row"), _number(rows, time).alias("time_number"))
    wanted = wanted.withColumn("stretch", stretch)

    last = held.groupBy(*keys, "stretch").agg(F.max_by("figure", "time_number").alias("figure"))
    none = F.lit(None).cast(held.schema["figure"].dataType)
    asked = wanted.select(*keys, "stretch").distinct().withColumn("figure", none)
    by_stretch = last.unionByName(asked).groupBy(*keys, "stretch").agg(F.max("figure").alias("figure"))
    before = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_stretch.withColumn("figure", F.last("figure", ignorenulls=True).over(before)).where("figure is not null")

    no_row = F.lit(None).cast(wanted.schema["row"].dataType)
    events = (
        wanted.withColumns({"figure": none, "kind": F.lit(ROW)})
        .unionByName(held.withColumns({"row": no_row, "kind": F.lit(FIGURE)}))
        .unionByName(carried.withColumns({
            "row": no_row, "kind": F.lit(CARRIED), "time_number": F.col("stretch").cast("bigint") * width,
        }))
    )
    so_far = Window.partitionBy(*keys, "stretch").orderBy("time_number", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    filled = events.withColumn("figure", F.last("figure", ignorenulls=True).over(so_far)).where(F.col("kind") == ROW)
    return filled.select("row.*", *(F.col(f"figure.{c}").alias(f"{prefix}{c}") for c in names))
