"""Mixing sources to target weights by hierarchical budgets.

Every document belongs to a leaf of the tree domain - language - source. A token budget
goes down the tree: a node's budget is split among its children by their weights, but
no child gets more than its subtree can supply (its tokens times ``max_epochs``). What a
full child leaves over goes to its siblings by weight; only what none of them can take
reaches the parent's siblings, because the parent's own supply is the sum of theirs.

A leaf whose budget is k times its tokens and some more passes all its documents k
times and then a prefix of epoch k: documents in the order of md5(seed, epoch, id), as
long as their tokens fit the rest. The prefix ends at a cut key of each leaf, so a
document's copies follow from its own id and its leaf's row, and no text is shuffled.
The cut is found from sums over 4,096 ranges of keys, and then inside the one range
that it falls in, so no task orders a whole leaf.

Tables by node have one row for each domain, language or source.

Defined results: null text has no tokens; null domain, language or source count as ''; a
document without tokens is taken if its key is in the prefix; rows with the same id
share a key and go together; a weight of 0 gives nothing; other columns are kept as
they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import WORD_PATTERN, written

LEVELS = ("domain", "lang", "source")
#: Hex digits of the key that name a range.
RANGE = 3


def n_tokens(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_PATTERN)).cast("bigint")


def water_fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` (parent columns, ``name``, weight, supply, budget of the parent) with the
    children's share: full children get their supply, others the same tokens a unit of
    weight. Children are full up to a ratio of supply and weight, which a running sum in
    that order finds."""
    live = F.col("weight") > 0
    supply = F.when(live, F.col("supply")).otherwise(0)
    ratio = F.when(live, supply / F.col("weight")).otherwise(0.0)
    rows = nodes.withColumn("supply", supply).withColumn("ratio", ratio)
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    up_to = group.orderBy("ratio", name).rowsBetween(Window.unboundedPreceding, 0)
    all_weight = F.sum("weight").over(group)
    rows = rows.withColumn("rest", all_weight - F.sum("weight").over(up_to)).withColumn("sum", F.sum("supply").over(up_to))
    rows = rows.withColumn("full", F.col("sum") + F.col("ratio") * F.col("rest") <= F.col("budget"))
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("supply")).otherwise(0)).over(group)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(group)
    share = F.when(F.col("full"), F.col("supply")).otherwise(F.floor(left / F.nullif(open_weight, F.lit(0)) * F.col("weight")))
    return rows.withColumn("share", F.least(share, F.col("supply")).cast("bigint")).drop("rest", "sum", "full", "ratio")


def leaf_budgets(leaves: DataFrame, weights: dict[tuple[str, ...], int], total: int, max_epochs: int) -> DataFrame:
    """leaves: (domain, lang, source, tokens); adds budget. ``weights`` maps a node's path to
    its weight among its siblings, 1 if not given."""
    spark = leaves.sparkSession
    kept = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    budgets = None
    for depth in range(1, len(LEVELS) + 1):
        path, parent = list(LEVELS[:depth]), list(LEVELS[: depth - 1])
        nodes = kept.groupBy(*path).agg(F.sum("supply").alias("supply"))
        own = [(*k, int(w)) for k, w in weights.items() if len(k) == depth]
        given = spark.createDataFrame(own, ", ".join(f"{c} string" for c in path) + ", weight bigint")
        nodes = nodes.join(F.broadcast(given), path, "left").withColumn("weight", F.coalesce("weight", F.lit(1)).cast("bigint"))
        nodes = nodes.withColumn("budget", F.lit(total).cast("bigint")) if budgets is None else nodes.join(budgets, parent)
        budgets = water_fill(nodes, parent, path[-1]).select(*path, F.col("share").alias("budget"))
    return leaves.join(budgets, list(LEVELS))


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    doc = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), doc).cast("binary"))


def leaf_cuts(docs: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """leaves (path, tokens, budget) with full (passes) and cut (the last key of the next
    epoch that fits, '' for none); docs: (path, doc_id, tokens)."""
    path = list(LEVELS)
    full = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)
    leaves = leaves.withColumn("full", full).withColumn("over", F.col("budget") - F.col("full") * F.col("tokens"))
    leaves = written(leaves.select(*path, "full", "over"), "leaves")
    keyed = docs.join(leaves.where("over > 0"), path).withColumn("key", _key(seed, F.col("full"), F.col("doc_id")))
    keyed = keyed.withColumn("range", F.substring("key", 1, RANGE))
    ranges = keyed.groupBy(*path, "range", "over").agg(F.sum("tokens").alias("n"))
    up_to = Window.partitionBy(*path).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranges.withColumn("sum", F.sum("n").over(up_to))
    # The range in which the rest is used up; all before it fit.
    edge = ranges.where("sum > over and sum - n <= over").select(*path, "range", (F.col("over") - F.col("sum") + F.col("n")).alias("room"))
    edge = written(edge, "edges")
    inside = keyed.join(edge, [*path, "range"]).groupBy(*path, "range", "room", "key").agg(F.sum("tokens").alias("n"))
    upto_key = Window.partitionBy(*path, "range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("sum", F.sum("n").over(upto_key)).where("sum <= room")
    last = inside.groupBy(*path).agg(F.max("key").alias("last"))
    cuts = edge.join(last, path, "left").select(*path, F.coalesce("last", "range").alias("cut"))
    # No edge: the rest of the leaf takes no document at all, or zero tokens were left.
    return leaves.join(cuts, path, "left").select(*path, "full", F.coalesce("cut", F.lit("")).alias("cut"))


def with_copies(
    docs: DataFrame, domain: Column, weights: dict[tuple[str, ...], int] | None = None, share: float = 0.75,
    max_epochs: int = 2, seed: int = 13, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """``docs`` with __domain, __lang, __source, __tokens and __copies: how often the mix holds
    the row. The budget is ``share`` of all tokens. Columns of ``docs`` that have one of these
    names, or __full or __cut, are left out."""
    docs = docs.drop("__domain", "__lang", "__source", "__tokens", "__copies", "__full", "__cut")
    leaf = {
        "__domain": F.coalesce(domain, F.lit("")), "__lang": F.coalesce(F.col(lang_col).cast("string"), F.lit("")),
        "__source": F.coalesce(F.col(source_col).cast("string"), F.lit("")),
    }
    rows = docs.select("*", *(c.alias(n) for n, c in leaf.items()), n_tokens(text_col).alias("__tokens"))
    small = rows.select(
        *(F.col(n).alias(n.removeprefix("__")) for n in leaf), F.col(id_col).alias("doc_id"), F.col("__tokens").alias("tokens")
    )
    small = written(small, "leaf-tokens")
    leaves = written(small.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "supply")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = written(leaf_budgets(leaves, weights or {}, int(total * share), max_epochs), "budgets")
    cuts = written(leaf_cuts(small, budgets, seed), "cuts")
    cuts = cuts.select(*(F.col(c).alias(f"__{c}") for c in LEVELS), F.col("full").alias("__full"), F.col("cut").alias("__cut"))
    key = _key(seed, F.col("__full"), F.col(id_col))
    copies = F.col("__full") + F.when(key <= F.col("__cut"), 1).otherwise(0)
    return rows.join(cuts, list(leaf)).withColumn("__copies", copies.cast("int")).drop("__full", "__cut")


def mixed_documents(
    docs: DataFrame, domain: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    source_col: str = "source", **how,
) -> DataFrame:
    """The mix: rows of ``docs``, each as often as the mix holds it."""
    # The row goes along as one column, so that no other has a name of its own.
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), domain.alias("of_domain"),
    )
    mixed = with_copies(rows, F.col("of_domain"), **how).where("__copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("row.*")
