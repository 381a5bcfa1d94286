"""SimHash near-dedup by a self-join of the binary trie of fingerprints.

The distinct fingerprints form a binary trie, most significant bit first. A node pair
(a, b) stands for all pairs of a fingerprint below a and one below b; the bits in which
the two prefixes differ are spent already. Starting from (root, root), both nodes of a
pair are split at the next bit, differing bits are added up, and a pair is dropped as
soon as it has spent more than the budget. The top of the traversal runs over counts by
prefix, the rest runs in tasks, one for each surviving pair of cut nodes.

Bounds. A cut node has at most n / ``nodes`` of the n fingerprints, and at most
``most_node``, so a task has at most two such nodes; heavy prefixes are split further,
down to single fingerprints. Fingerprints go to as many tasks as their node has partners, which
follows from the depth of the cut and not from n. Two distinct 64-bit fingerprints within two bits of one have 2,080
possible values, so the traversal stays linear in n for any grouping of the texts. A
task returns a spanning forest of the links it finds, never the pairs of a group;
components over the forests of all tasks equal those over all links.

Defined results: null and empty texts have fingerprint zero and are linked like any
other; texts with fewer words than a shingle have one shingle, the whole sequence;
repeated rows and equal texts share a fingerprint and hence a component; null ids get
the component of their fingerprint; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, slices, written
from tillroll.llm.components import least_of_component

BITS = 64
#: Pairs of nodes and of fingerprints held at once while a task traverses.
NODE_BLOCK, PAIR_BLOCK = 1 << 16, 1 << 20


def fingerprint(text: bytes, n: int) -> int:
    """A bit is set if it is set in over half of the hashes of the text's shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = max(1, len(words) - n + 1)
    spans = zip(starts[:size].tolist(), ends[-size:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, size)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, size, 1 << 14):
        block = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > size).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [fingerprint(t, shingle) for t in byte_texts(batch.column("text"))]
            fp = np.array(made, np.uint64).view(np.int64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(fp, pa.int64())})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp bigint")


def split_pairs(a0, a1, b0, b1, spent, middle: Callable, budget: int):
    """The child pairs of node pairs, without those that are empty or over budget.
    Nodes are ranges of a sorted array; ``middle(lo, hi)`` is where the next bit turns
    from 0 to 1. A pair of a node with itself has three children, others four."""
    am, bm = middle(a0, a1), middle(b0, b1)
    same = (a0 == b0) & (a1 == b1)
    out = []
    for lo1, hi1, lo2, hi2, more, mask in (
        (a0, am, b0, bm, 0, None),
        (am, a1, bm, b1, 0, None),
        (a0, am, bm, b1, 1, None),
        (am, a1, b0, bm, 1, ~same),
    ):
        keep = (hi1 > lo1) & (hi2 > lo2) & (spent + more <= budget)
        keep = keep if mask is None else keep & mask
        out.append([x[keep] for x in (lo1, hi1, lo2, hi2)] + [spent[keep] + more])
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def trie_links(left: np.ndarray, right: np.ndarray | None, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (x, y) positions with at most ``budget`` differing bits, found by the
    paired traversal of the tries of two sorted arrays of distinct fingerprints, or of
    one with itself. Positions of ``right`` follow those of ``left``."""
    values = left if right is None else np.concatenate((left, right))
    n, total = len(left), len(values)
    second = (0, n) if right is None else (n, total)
    start = [np.array([x]) for x in (0, n, *second)] + [np.zeros(1, np.int64)]
    stack = [(BITS, start)]
    while stack:
        level, pairs = stack.pop()
        sizes = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
        small = (sizes <= 64) | (level == 0)
        if small.any():
            yield from _compared(values, [x[small] for x in pairs], sizes[small], budget)
        pairs = [x[~small] for x in pairs]
        if len(pairs[0]):
            # The first position of a node's 1-branch, by one search for all nodes.
            bit = np.uint64(1) << np.uint64(level - 1)
            # The nodes of each side are ranges in that side's sorted part.
            def middle(lo, hi, bit=bit):
                mark = (values[lo] | bit) & ~(bit - np.uint64(1))
                first = np.searchsorted(values[:n], mark)
                other = n + np.searchsorted(values[n:], mark)
                return np.clip(np.where(lo < n, first, other), lo, hi)

            children = split_pairs(*pairs, middle, budget)
            for at in range(0, len(children[0]), NODE_BLOCK):
                stack.append((level - 1, [x[at : at + NODE_BLOCK] for x in children]))


def _compared(values, pairs, sizes, budget):
    a0, _, b0, b1, _ = pairs
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + PAIR_BLOCK, "right")))
        size = sizes[begin:end]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = np.repeat((b1 - b0)[begin:end], size)
        x = np.repeat(a0[begin:end], size) + place // width
        y = np.repeat(b0[begin:end], size) + place % width
        near = np.bitwise_count(values[x] ^ values[y]) <= budget
        near &= x != y
        if near.any():
            yield x[near], y[near]
        begin = end


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least position in each position's component, links taken block by block."""
    root = np.arange(n)
    for x, y in links:
        while True:
            a, b = root[x], root[y]
            apart = a != b
            if not apart.any():
                break
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root, jumped := root[root]):
                root = jumped
    return root


def cut_nodes(fps: DataFrame, nodes: int, most_node: int, step: int = 8) -> list[tuple[int, int]]:
    """(prefix, depth) of the trie nodes at which tasks begin: every fingerprint is below
    exactly one, and a node has at most min(n / nodes, most_node) fingerprints, or
    one. Counts are taken ``step`` bits at a time, below heavy nodes only; as fewer than
    max(nodes, n / most_node) can be heavy at a depth, a count has at most 2**step times
    as many rows."""
    total = fps.count()
    most = max(1, min(-(-total // nodes), most_node))
    if total <= most:
        return [(0, 0)]
    done, heavy, depth = [], None, 0
    while depth < BITS and (heavy is None or heavy):
        top = fps
        if heavy is not None:
            kept = fps.sparkSession.createDataFrame([(p,) for p in heavy], "p bigint")
            top = fps.join(F.broadcast(kept), F.shiftrightunsigned("fp", BITS - depth) == F.col("p"), "left_semi")
        key = F.shiftrightunsigned("fp", BITS - depth - step) if depth + step < BITS else F.col("fp")
        table = top.groupBy(key.alias("p")).count().toArrow()
        prefix = table.column("p").to_numpy().view(np.uint64)
        count = table.column("count").to_numpy()
        order = np.argsort(prefix)
        prefix, ends = prefix[order], np.concatenate(([0], np.cumsum(count[order])))
        heavy_now: list[int] = []
        ranges = [(int(p), depth) for p in ([0] if heavy is None else np.array(heavy, np.int64).view(np.uint64))]
        while ranges:
            p, d = ranges.pop()
            left = depth + step - d
            lo = int(np.searchsorted(prefix, np.uint64(p << left)))
            hi = len(prefix) if p + 1 == 1 << d else int(np.searchsorted(prefix, np.uint64((p + 1) << left)))
            if lo == hi:
                continue
            if ends[hi] - ends[lo] <= most or d == BITS:
                done.append((p, d))
            elif left == 0:
                heavy_now.append(int(np.uint64(p).view(np.int64)))
            else:
                ranges += [(2 * p, d + 1), (2 * p + 1, d + 1)]
        heavy, depth = heavy_now, depth + step
    return done


def cut_pairs(nodes: list[tuple[int, int]], budget: int) -> list[tuple[int, int]]:
    """Places of the node pairs that the traversal from (root, root) reaches: a cut node
    stays while its partner goes on to deeper bits, and only bits that both have are
    spent."""
    starts = np.array([p << (BITS - d) for p, d in nodes], np.uint64)
    order = np.argsort(starts)
    depth = np.array([d for _, d in nodes])[order]
    starts = starts[order]
    out = []
    stack = [(0, len(nodes), 0, len(nodes), 0, 0)]
    while stack:
        a0, a1, b0, b1, level, spent = stack.pop()
        whole_a = a1 - a0 == 1 and depth[a0] <= level
        whole_b = b1 - b0 == 1 and depth[b0] <= level
        if whole_a and whole_b:
            out.append((int(order[a0]), int(order[b0])))
            continue
        halves = []
        for lo, hi, whole in ((a0, a1, whole_a), (b0, b1, whole_b)):
            if whole:
                halves.append(((lo, hi, None),))
            else:
                bit = np.uint64(1) << np.uint64(BITS - 1 - level)
                mid = lo + int(np.searchsorted((starts[lo:hi] & bit) > 0, True))
                halves.append(((lo, mid, 0), (mid, hi, 1)))
        for lo1, hi1, x in halves[0]:
            for lo2, hi2, y in halves[1]:
                more = int(x is not None and y is not None and x != y)
                mirrored = (a0, a1) == (b0, b1) and x == 1 and y == 0
                if hi1 > lo1 and hi2 > lo2 and spent + more <= budget and not mirrored:
                    stack.append((lo1, hi1, lo2, hi2, level + 1, spent + more))
    return out


def fingerprint_links(fps: DataFrame, budget: int, nodes: int = 64, most_node: int = 1 << 21) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps`` (fp long): a spanning forest for
    every pair of cut nodes, over all pairs with at most ``budget`` differing bits."""
    spark = fps.sparkSession
    cuts = cut_nodes(fps, nodes, most_node)
    pairs = cut_pairs(cuts, budget)
    members: list[list[tuple[int, int]]] = [[] for _ in cuts]
    for k, (a, b) in enumerate(pairs):
        members[a].append((k, 0))
        if a != b:
            members[b].append((k, 1))
    # The cut nodes and their pairs: at most nodes * 2**8 rows a counted depth, whatever n.
    starts = np.array([p << (BITS - d) for p, d in cuts], np.uint64)
    order = np.argsort(starts)
    starts = starts[order]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fp = batch.column("fp").to_numpy()
            if not len(fp):
                continue
            node = order[np.searchsorted(starts, fp.view(np.uint64), "right") - 1]
            rows = [members[i] for i in node]
            sizes = np.array([len(r) for r in rows])
            flat = np.array([x for r in rows for x in r], np.int64).reshape(-1, 2)
            out = {"pair": pa.array(flat[:, 0]), "side": pa.array(flat[:, 1]), "fp": pa.array(np.repeat(fp, sizes))}
            yield from pa.Table.from_pydict(out).to_batches(max_chunksize=1 << 16)

    def joined(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        left = np.sort(fp[side == 0])
        right = np.sort(fp[side == 1])
        values = np.concatenate((left, right))
        root = forest(len(values), trie_links(left, right if len(right) else None, budget))
        moved = np.flatnonzero(root != np.arange(len(root)))
        ends = values[root[moved]].view(np.int64), values[moved].view(np.int64)
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    if not pairs:
        return spark.createDataFrame([], "a bigint, b bigint")
    spread = fps.select("fp").mapInArrow(dealt, "pair bigint, side bigint, fp bigint")
    return spread.groupBy("pair").applyInArrow(joined, "a bigint, b bigint")


def simhash_groups(
    docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str, nodes: int, most_node: int
) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, fp), and every fingerprint's (fp, root, component_id)."""
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = least_of_component(fingerprint_links(classes, max_bits, nodes, most_node))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rows, rooted.join(least, "root").select("fp", "root", "component_id")


def simhash_components(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
    nodes: int = 64, most_node: int = 1 << 21,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the least id
    among the rows that links reach, the row itself included."""
    rows, groups = simhash_groups(docs, shingle, max_bits, id_col, text_col, nodes, most_node)
    return rows.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
    nodes: int = 64, most_node: int = 1 << 21,
) -> DataFrame:
    """The rows of ``docs`` with one row of each component: that with the least id. Ids
    that have several rows are settled row by row: where more than one of a component
    has the least id, the least in the order of all columns stays."""
    # Names that no column of this operator has.
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = dict(zip(docs.columns, names, strict=True))
    kept = _deduped(docs.toDF(*names), shingle, max_bits, plain[id_col], plain[text_col], nodes, most_node)
    return kept.toDF(*docs.columns)


def _deduped(
    docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str, nodes: int, most_node: int
) -> DataFrame:
    rows, groups = simhash_groups(docs, shingle, max_bits, id_col, text_col, nodes, most_node)
    groups = written(groups, "groups")
    least = rows.join(groups, "fp").groupBy(F.col("doc_id").alias("__id")).agg(
        F.count("*").alias("__rows"), F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("__stays")
    )
    least = written(least.where("__stays").select("__id", "__rows"), "keepers")
    same = F.col(id_col).eqNullSafe(F.col("__id"))
    # Both joins shuffle the documents by id in the same way, so it is done once, at
    # every size alike.
    once = docs.join(least.where("__rows = 1").hint("merge"), same, "left_semi")

    @F.pandas_udf("bigint")
    def fp_of(texts):
        made = [fingerprint((t or "").encode(), shingle) for t in texts]
        return type(texts)(np.array(made, np.uint64).view(np.int64))

    several = docs.join(least.where("__rows > 1").hint("merge"), same, "left_semi")
    several = several.withColumn("__fp", fp_of(F.col(text_col)))
    named = groups.select(*(F.col(c).alias(f"__{c}") for c in groups.columns))
    # Null-safe, as Spark would test a plain key for null before the join with the ids,
    # and so compute it for every document.
    several = several.join(named.withColumnRenamed("__fp", "__key"), F.col("__fp").eqNullSafe(F.col("__key")))
    several = several.where(F.col(id_col).eqNullSafe(F.col("__component_id")))
    row = several.groupBy("__root").agg(F.min(F.struct(*docs.columns)).alias("__row"))
    return once.unionByName(row.select("__row.*"))
