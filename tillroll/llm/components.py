"""Connected components by alternating stars over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the least of the node and its
    neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them. Edges
    come as (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def least_of_component(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long), root the least node
    of its component. Self-links, repeated links and either order are fine; a node
    without a link to another does not appear.

    Each round is two aggregates and two joins; it is written to the shared folder.
    A hub is one row on the aggregate's side of a join, and the other side's rows of it
    are split by the adaptive skew join, so no group is gathered anywhere."""
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = _signature(edges)
    while before[0]:
        edges = written(_smaller_to_least(_larger_to_least(edges)), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
