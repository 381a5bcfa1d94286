"""Reconciliation of two runs: the rows that one has more often than the other.

Every row has two 64-bit hashes; the first deals rows to buckets. A run's digest is one row per
bucket: how many rows it has, and both hashes added up (as decimals and by exclusive or,
which do not depend on an order). Digests are small, bounded by the number of buckets, and may be
kept with a run. Two runs are compared by their digests, and only rows of buckets
whose digests differ are compared themselves: both sides are put in one table with a count
of each kind and aggregated by the whole row, so nothing is joined, and a row that fills a
third of a run is one row per task.

``differences`` is what ``exceptAll`` gives both ways, duplicates included, with counts in
place of copies. Defined results: nulls equal each other, as in grouping; columns are taken by
name, and the runs must have the same ones; maps cannot be compared; two empty runs agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
LEFT, RIGHT = "left_rows", "right_rows"


def _hashes(columns: list[str]) -> tuple[Column, Column]:
    # Nulls do not change a hash, so where they are is hashed as well.
    nulls = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*columns, *nulls), F.xxhash64(F.lit("second"), *nulls, *columns)


def bucket_of(columns: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(_hashes(columns)[0], F.lit(buckets)).cast("int")


def run_digest(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n, x, s``: at most ``buckets`` rows."""
    columns = sorted(rows.columns)
    first, second = _hashes(columns)
    hashed = rows.select(bucket_of(columns, buckets).alias("bucket"), first.alias("a"), second.alias("b"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("x"), F.sum(F.col("b").cast("decimal(20,0)")).alias("s")
    )


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """The buckets whose digests differ, of two results of :func:`run_digest`."""
    both = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    # Equal digests cancel; a bucket that one side lacks is left over.
    kept = both.groupBy("bucket", "n", "x", "s").agg(F.sum("side").alias("sides")).where("sides <> 0")
    return kept.select("bucket").distinct()


def differences(
    left: DataFrame, right: DataFrame, buckets: int = BUCKETS,
    left_digest: DataFrame | None = None, right_digest: DataFrame | None = None,
) -> DataFrame:
    """``left``'s columns, ``left_rows`` and ``right_rows`` of every row that the two do not have
    equally often. Kept digests (with the same ``buckets``) save a pass over the runs."""
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("the runs have different columns")
    columns = left.columns
    differ = differing_buckets(
        run_digest(left, buckets) if left_digest is None else left_digest,
        run_digest(right, buckets) if right_digest is None else right_digest,
    )
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = left.withColumns({LEFT: one, RIGHT: none}).unionByName(right.withColumns({LEFT: none, RIGHT: one}))
    # At most ``buckets`` numbers: bounded, so they may go to every task.
    some = both.withColumn("bucket", bucket_of(sorted(columns), buckets)).join(F.broadcast(differ), "bucket", "left_semi")
    counted = some.groupBy(*columns).agg(F.sum(LEFT).alias(LEFT), F.sum(RIGHT).alias(RIGHT))
    return counted.where(F.col(LEFT) != F.col(RIGHT))


def surplus(found: DataFrame, side: str = LEFT) -> DataFrame:
    """The rows that one side has more often, as often as it has them more: what
    ``exceptAll`` returns."""
    other = RIGHT if side == LEFT else LEFT
    more = found.where(F.col(side) > F.col(other))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(side) - F.col(other)))
    return more.withColumn("copy", copies).drop("copy", LEFT, RIGHT)
