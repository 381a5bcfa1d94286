"""A lattice of stored aggregates that answers coarse sum reports from finer ones.

A node is a written table of partial sums: a set of dimensions, the date text cut to a day,
month or year, and for each measure its sum and the number of its lines that are not zero.
It is computed from the fact or, where it has a parent, from the parent's table. So
the fact is scanned once for each node without a parent (three times for 17 reports),
and what comes after reads tables that have one row per key.

A node answers a report exactly if the report's row rules can be judged on its rows:

* all dimensions of the report and of its non-empty rule are dimensions of the node;
* the date is cut no coarser than the report needs. A cut date keeps its places
  (``00-03-2017``, ``00-00-2017``), so an empty date stays empty and the month can be read;
* ``sale_year`` stays a key and is the partition column, so the year rule prunes folders;
* ``bad_fields`` stays a key: lines with unreadable fields keep rows of their own, and a
  report that reads such a field fails here too;
* a measure's sum is null only if all its lines have none, as a missing measure;
* lines of zero count for the zero policies, so their complement is kept beside the sum
  (``measure_by`` asks for it): lines that cancel to zero are not lines of zero.

Sums are mergeable: a further batch of lines may be appended to the nodes, and the reports
add the parts up.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.measures import nonzero_lines
from tillroll.plans.reports import GEO, REP, REPORTS
from tillroll.schema import BAD_FIELDS, DEFAULT_EXCLUDED_YEAR
from tillroll.session import remove_path

# What a date text is cut to: the part that is kept, from which character on, after zeros.
CUTS = {"day": ("", 1), "month": ("00", 3), "year": ("00-00", 6)}


@dataclass(frozen=True)
class Node:
    name: str
    cut: str
    dims: tuple[str, ...]
    parent: str | None
    answers: tuple[str, ...]


PERSON = ("rep_id", "rep_name")

# Parents come before their children.
NODES: dict[str, Node] = {
    node.name: node
    for node in (
        Node("day_place", "day", GEO, None, ("zone_daily_quantity", "zone_daily_value")),
        Node("day", "day", (), "day_place", ("daily_quantity", "daily_value")),
        Node("month", "month", (), "day", ("quarter_quantity", "quarter_value")),
        Node("seller", "year", (*GEO, *REP), None, ("rep_contribution_quantity", "rep_contribution_value")),
        Node("person_place", "year", (*GEO, *PERSON), "seller", (
            "salesperson_quantity", "salesperson_value", "zone_salesperson_quantity", "zone_salesperson_value",
        )),
        Node("rep_category", "year", REP, "seller", ("rep_category_quantity",)),
        Node("category_place", "year", (*GEO, "category"), "seller", ("zone_category_quantity",)),
        Node("category", "year", ("category",), "category_place", ("category_quantity",)),
        Node("subcategory_place", "year", (*GEO, "sub_category"), None, ("zone_subcategory_quantity",)),
        Node("subcategory", "year", ("sub_category",), "subcategory_place", ("subcategory_quantity",)),
    )
}

NODE_OF: dict[str, str] = {report: node.name for node in NODES.values() for report in node.answers}


def line_of(name: str) -> list[str]:
    """The node and its ancestors, the one that reads the fact first."""
    node = NODES[name]
    return [*(line_of(node.parent) if node.parent else []), name]


def measures_of(name: str) -> tuple[str, ...]:
    """The measures that the node's reports, or its descendants', sum up."""
    own = {m for r in NODES[name].answers for m in REPORTS[r].parsed if m != "sale_date"}
    below = {m for child in NODES.values() if child.parent == name for m in measures_of(child.name)}
    return tuple(sorted(own | below))


def node_schema(name: str) -> T.StructType:
    text = [*NODES[name].dims, "sale_date", BAD_FIELDS]
    numbers = [c for m in measures_of(name) for c in (m, nonzero_lines(m))]
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in text]
        + [T.StructField(c, T.LongType()) for c in numbers]
        + [T.StructField("sale_year", T.StringType())]
    )


def cut_date(cut: str) -> Column:
    """The date text with zeros in place of what is finer than ``cut``; empty stays empty."""
    zeros, start = CUTS[cut]
    date = F.col("sale_date")
    if not zeros:
        return date
    return F.when(date != "", F.concat(F.lit(zeros), F.substring(date, start, 11 - start))).otherwise(date)


def node_rows(source: DataFrame, name: str) -> DataFrame:
    """The node's partial sums over sale lines or over the rows of an ancestor."""
    node = NODES[name]
    sums = []
    for m in measures_of(name):
        lines = nonzero_lines(m)
        sums.append(F.sum(m).alias(m))
        sums.append((F.sum(lines) if lines in source.columns else F.count_if(F.col(m) != 0)).alias(lines))
    if BAD_FIELDS not in source.columns:
        source = source.withColumn(BAD_FIELDS, F.lit(None).cast(T.StringType()))
    keys = [*node.dims, cut_date(node.cut).alias("sale_date"), BAD_FIELDS, "sale_year"]
    return source.groupBy(*keys).agg(*sums).select(*node_schema(name).names)


def store_lattice(
    fact: DataFrame, folder: str, names: tuple[str, ...] | list[str] | None = None, mode: str = "overwrite"
) -> list[str]:
    """Write the nodes that ``names`` (all if none are given) need under ``folder``; returns
    those written, in order. ``mode="append"`` adds the lines of a further batch: their own
    nodes are written beside the folder, appended to it and removed."""
    spark = fact.sparkSession
    wanted = [n for n in NODES if names is None or any(n in line_of(x) for x in names)]
    if mode == "append":
        batch = f"{folder.rstrip('/')}-batch-{uuid.uuid4().hex[:12]}"
        store_lattice(fact, batch, wanted)
        for name in wanted:
            _write(read_node(spark, batch, name), f"{folder.rstrip('/')}/{name}", "append")
        remove_path(spark, batch)
        return wanted
    for name in wanted:
        parent = NODES[name].parent
        source = read_node(spark, folder, parent) if parent else fact
        _write(node_rows(source, name), f"{folder.rstrip('/')}/{name}", mode)
    return wanted


def _write(rows: DataFrame, path: str, mode: str) -> None:
    rows.write.mode(mode).option("compression", "zstd").partitionBy("sale_year").parquet(path)


def read_node(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = node_schema(name)
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}").select(*schema.names)


def answer(
    spark: SparkSession, folder: str, report: str, excluded_year: str = DEFAULT_EXCLUDED_YEAR
) -> DataFrame:
    """The report from its stored node: its own row rules and its own plan over partial
    sums."""
    if report not in NODE_OF:
        raise ValueError(f"no stored aggregate answers {report!r}")
    return REPORTS[report].run(read_node(spark, folder, NODE_OF[report]), excluded_year)
