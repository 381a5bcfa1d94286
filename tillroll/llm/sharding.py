"""Minimum-cost-flow resharding.

Given the byte sizes of the old shards and the byte capacities of the new ones, a
minimum-cost flow tells how many bytes go from each old shard to each new shard so that
the fewest bytes move (a byte that stays in the shard of its number costs nothing;
other costs may be given). The flow is over shards, not rows: its graph has old * new
arcs whatever the data.

An old shard is a line of blocks, and a block a line of rows in the order of a hash.
The flow cuts the line into stretches, one for each new shard, the one that stays first;
a row goes with the stretch that its middle byte is in. So a new shard misses its
capacity by at most half a row at each of its stretches' ends. Blocks that one stretch
covers move whole, as a folder that is given to another shard; of a store, only files of
blocks that are cut are rewritten.

The driver holds sums by block, whose number follows from ``block_rows``. Rows that are
equal in id, size and checksum are one row with a count until the end, so neither a
repeated row nor its copies gather in one task.

Defined results: a null text has no bytes and the checksum of the empty text; a null id
is in old shard 0; rows with the same id are rows of their own; an empty table gives
an empty result; ties of the hash are ordered by id, size and checksum; other columns
are not read.
"""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written
from tillroll.session import scratch_path

#: Bytes of a row besides its text.
ROW_BYTES = 8
#: Folder levels of a store.
SHARD, BLOCK = "in_shard", "in_block"


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> list[list[int]]:
    """flow[i][j]: how much of supply i goes to j, all of it, at the least total of
    cost(i, j) a unit; by successive shortest paths with potentials. The capacities add
    up to at least the supplies; costs are at least 0."""
    m, n = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("the capacities are less than the supplies")
    left, room = list(supply), list(capacity)
    flow = [[0] * n for _ in range(m)]
    potential = [0] * (m + n)
    while any(left):
        far = [float("inf")] * (m + n)
        before = [-1] * (m + n)
        queue = [(0, i) for i in range(m) if left[i]]
        for _, i in queue:
            far[i] = 0
        heapq.heapify(queue)
        while queue:
            d, x = heapq.heappop(queue)
            if d > far[x]:
                continue
            if x < m:
                steps = ((m + j, cost(x, j)) for j in range(n))
            else:
                steps = ((i, -cost(i, x - m)) for i in range(m) if flow[i][x - m])
            for y, price in steps:
                e = d + price + potential[x] - potential[y]
                if e < far[y]:
                    far[y], before[y] = e, x
                    heapq.heappush(queue, (e, y))
        end = min((m + j for j in range(n) if room[j]), key=lambda y: far[y] + potential[y])
        potential = [p + min(f, far[end]) for p, f in zip(potential, far, strict=True)]
        path = [end]
        while before[path[-1]] >= 0:
            path.append(before[path[-1]])
        path.reverse()
        back = [(path[k + 1], path[k] - m) for k in range(1, len(path) - 1, 2)]
        amount = min(left[path[0]], room[end - m], *(flow[i][j] for i, j in back)) if back else min(left[path[0]], room[end - m])
        for k in range(0, len(path) - 1, 2):
            flow[path[k]][path[k + 1] - m] += amount
        for i, j in back:
            flow[i][j] -= amount
        left[path[0]] -= amount
        room[end - m] -= amount
    return flow


def even(total: int, n: int) -> list[int]:
    return [total // n + (i < total % n) for i in range(n)]


def stay(i: int, j: int) -> int:
    return int(i != j)


def stretches(flow: list[int], old: int) -> tuple[list[int], list[int]]:
    """Ends (bytes) and new shards of an old shard's stretches; what stays comes first."""
    order = sorted((j for j in range(len(flow)) if flow[j]), key=lambda j: (j != old, j))
    return list(accumulate(flow[j] for j in order)), order


def row_key(id_col: str, text_col: str) -> dict[str, Column]:
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return {
        "doc_id": F.col(id_col), "size": (F.octet_length(data) + ROW_BYTES).cast("bigint"), "text_crc32": F.crc32(data),
    }


def named(columns: dict[str, Column], prefix: str = "") -> list[Column]:
    return [c.alias(prefix + n) for n, c in columns.items()]


def place_of(columns: dict[str, Column]) -> Column:
    """A row's place in the order of its old shard."""
    return F.xxhash64(*columns.values())


def hash_shard(doc_id: Column, n: int) -> Column:
    key = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(key % n, F.lit(0)).cast("int")


def blocked(rows: DataFrame, old: Column, shards: int, block_rows: int) -> DataFrame:
    """Distinct rows with their count, old shard, place in its order, and block."""
    classes = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("times"))
    classes = classes.withColumn("old", old).withColumn("place", F.xxhash64("doc_id", "size", "text_crc32"))
    n = rows.count()
    bits = max(4, (n // (shards * block_rows)).bit_length())
    return written(classes.withColumn("block", F.shiftrightunsigned("place", 64 - bits).cast("int")), "blocks")


def plan(blocks: DataFrame, n_old: int, capacities: list[int] | int, cost=stay) -> tuple[list[tuple], list[list[int]]]:
    """(old, block, offset, ends, targets) of every block, and the flow. ``capacities``: bytes
    of the new shards, or their number for even ones."""
    sums = blocks.groupBy("old", "block").agg(F.sum(F.col("size") * F.col("times")).alias("n"))
    table = sorted(tuple(r) for r in sums.collect())
    supply = [0] * n_old
    offsets = []
    for old, _, n in table:
        offsets.append(supply[old])
        supply[old] += n
    room = even(sum(supply), capacities) if isinstance(capacities, int) else capacities
    flow = min_cost_flow(supply, room, cost)
    ways = [stretches(f, i) for i, f in enumerate(flow)]
    return [(old, block, at, *ways[old]) for (old, block, _), at in zip(table, offsets, strict=True)], flow


def assigned(blocks: DataFrame, planned: list[tuple]) -> DataFrame:
    """``blocks`` with shard, first and times: of a distinct row's copies, ``times`` from
    number ``first`` go to ``shard``; ``parts`` is the number of shards that they go to."""
    spark = blocks.sparkSession
    ways = spark.createDataFrame(
        planned, "old int, block int, offset bigint, ends array<bigint>, targets array<int>"
    )
    order = Window.partitionBy("old", "block").orderBy("place", "doc_id", "size", "text_crc32")
    weight = F.col("size") * F.col("times")
    rows = blocks.join(F.broadcast(ways), ["old", "block"])
    rows = rows.withColumn("offset", F.col("offset") + F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, 0)) - weight)
    # Copies whose middle lies before a stretch's end: (end - offset + size / 2) / size.
    before = F.transform(
        "ends",
        lambda e: F.greatest(F.lit(0), F.least(F.col("times"), F.floor((e - F.col("offset") + F.expr("size div 2")) / F.col("size")))).cast("bigint"),
    )
    rows = rows.withColumn("before", before)
    # The last stretch takes what rounding leaves.
    parts = F.transform(
        F.sequence(F.lit(0), F.size("before") - 1),
        lambda k: F.struct(
            F.element_at("targets", k + 1).alias("shard"),
            F.when(k == 0, F.lit(0)).otherwise(F.element_at("before", F.greatest(k, F.lit(1)))).cast("bigint").alias("first"),
            F.when(k == F.size("before") - 1, F.col("times")).otherwise(F.element_at("before", k + 1)).cast("bigint").alias("end"),
        ),
    )
    rows = rows.withColumn("ways", F.filter(parts, lambda p: p["end"] > p["first"]))
    keys = ["doc_id", "size", "text_crc32", "old", "block", "place"]
    rows = rows.select(*keys, F.size("ways").alias("parts"), F.explode("ways").alias("part"))
    return rows.select(
        *keys, F.col("part.shard").alias("shard"), F.col("part.first").alias("first"),
        (F.col("part.end") - F.col("part.first")).alias("times"), "parts",
    )


def reshard(
    docs: DataFrame, shards: int = 24, old_shards: int = 16, old: Column | None = None, cost=stay,
    block_rows: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text", copies_in_step: int = 1 << 16,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, and
    old_shard. ``old`` (over doc_id) gives the old shard, by default the crc32 of the id."""
    spark = docs.sparkSession
    old = hash_shard(F.col("doc_id"), old_shards) if old is None else old
    blocks = blocked(docs.select(*named(row_key(id_col, text_col))), old, old_shards, block_rows)
    planned, _ = plan(blocks, old_shards, shards, cost)
    return numbered(written(assigned(blocks, planned), "assigned"), shards, copies_in_step)


def numbered(rows: DataFrame, shards: int, copies_in_step: int = 1 << 16) -> DataFrame:
    """One row for each of the ``times`` copies of ``rows`` (distinct rows with old, block, place,
    shard and first), with its slot in the shard."""
    spark = rows.sparkSession
    sums = rows.groupBy("shard", "old", "block").agg(F.sum("times").alias("n")).collect()
    base, bases = [0] * shards, []
    for r in sorted(tuple(r) for r in sums):
        bases.append((*r[:3], base[r[0]]))
        base[r[0]] += r[3]
    begins = spark.createDataFrame(bases, "shard int, old int, block int, base bigint")
    order = Window.partitionBy("old", "block", "shard").orderBy("place", "doc_id", "size", "text_crc32", "first")
    rows = rows.join(F.broadcast(begins), ["shard", "old", "block"]).withColumn(
        "slot", F.col("base") + F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("times")
    )
    steps = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1, F.lit(copies_in_step).cast("bigint")))
    many = rows.where("times > 1").withColumn("step", steps).repartition("doc_id", "step")
    last = F.least(F.col("step") + copies_in_step, F.col("times")) - 1
    many = many.withColumn("copy", F.explode(F.sequence("step", last))).withColumn("slot", F.col("slot") + F.col("copy"))
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "old"]
    out = rows.where("times = 1").select(*columns).unionByName(many.select(*columns))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"),
    )


def write_store(docs: DataFrame, path: str, shards: int, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as a store: a folder for each shard (crc32 of the id) and block. Rows are
    dealt by shard and block first, so that a folder has few files; Spark splits what
    is larger than its advisory size, such as a block with a much repeated row."""
    block = F.shiftrightunsigned(place_of(row_key(id_col, text_col)), 64 - bits).cast("int")
    rows = docs.withColumns({SHARD: hash_shard(F.col(id_col), shards), BLOCK: block})
    rows.hint("rebalance", SHARD, BLOCK).write.partitionBy(SHARD, BLOCK).parquet(path)


def reshard_store(
    spark: SparkSession, path: str, new_path: str, capacities: list[int] | int, old_shards: int, cost=stay,
    id_col: str = "doc_id", text_col: str = "text",
) -> list[tuple[int, str]]:
    """Reshard the store at ``path``. Blocks that stay whole are left where they are; the
    rows of the others are written below ``new_path``. Returns the new store's (shard,
    folder) pairs, one for each block and each of its new shards."""
    stored = spark.read.parquet(path)
    key = row_key(id_col, text_col)
    at_old = [F.col(SHARD).alias("old"), F.col(BLOCK).alias("block")]
    blocks = stored.select(*at_old, *named(key)).groupBy("old", "block", *key).agg(F.count("*").alias("times"))
    blocks = written(blocks.withColumn("place", F.xxhash64(*key)), "blocks")
    rows = written(assigned(blocks, plan(blocks, old_shards, capacities, cost)[0]), "assigned")
    targets: dict[tuple[int, int], set[int]] = {}
    for old, block, shard in rows.select("old", "block", "shard").distinct().collect():
        targets.setdefault((old, block), set()).add(shard)
    out = [(min(t), f"{path}/{SHARD}={o}/{BLOCK}={b}") for (o, b), t in targets.items() if len(t) == 1]
    cut = sorted(b for b, t in targets.items() if len(t) > 1)
    if cut:
        _cut_rows(stored, key, rows, cut).write.partitionBy(SHARD, BLOCK).parquet(new_path)
        out += {(s, f"{new_path}/{SHARD}={s}/{BLOCK}={b}") for o, b in cut for s in targets[o, b]}
    return sorted(out)


#: Rows of a file that are numbered together.
NUMBERED = 1 << 16


def _cut_rows(stored: DataFrame, key: dict[str, Column], rows: DataFrame, cut: list[tuple[int, int]]) -> DataFrame:
    """The stored rows of the blocks ``cut``, with their new shard.

    Copies of a row that all go to one shard need no number. Of the others, at most one
    distinct row at each end of a stretch, a copy's number follows from its file and its place
    in it, so a repeated task gives it the same one; copies are counted by stretches of files
    first, and only a stretch is numbered in one place."""
    moved = F.broadcast(stored.sparkSession.createDataFrame(cut, "old int, block int"))
    way = rows.join(moved, ["old", "block"], "left_semi")
    names = [c for c in stored.columns if c not in (SHARD, BLOCK)]
    on = ["old", "block", *key]
    some = stored.select(
        F.struct(*names).alias("row"), F.struct(F.col(SHARD).alias("old"), F.col(BLOCK).alias("block"), *named(key)).alias("class"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"),
    ).join(moved, (F.col("class.old") == moved["old"]) & (F.col("class.block") == moved["block"]), "left_semi")

    way = way.select(F.struct(*on).alias("class"), F.col("shard").alias("to"), "first", "times", "parts")
    # Equality of the whole structs, in which nulls equal each other.
    plain = some.alias("s").join(way.where("parts = 1").alias("w"), F.expr("s.class <=> w.class")).select("row", "s.class", "to")
    # At most one distinct row for each end of a stretch: bounded, so they may go to every task.
    shared = F.broadcast(way.where("parts > 1")).alias("w")
    split = some.alias("s").join(shared, F.expr("s.class <=> w.class"), "left_semi")
    split = split.withColumn("stretch", F.floor(F.col("at") / NUMBERED))
    counts = split.groupBy("class", "file", "stretch").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("class").orderBy("file", "stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("class", "file", "stretch", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("class", "file", "stretch").orderBy("at")) - 1
    numbers = split.withColumn("inside", inside).alias("s").join(
        counts.alias("c"), F.expr("s.class <=> c.class and s.file = c.file and s.stretch = c.stretch")
    ).select("row", "s.class", (F.col("inside") + F.col("before")).alias("number"))
    copies = numbers.alias("s").join(
        shared, F.expr("s.class <=> w.class and s.number >= w.first and s.number < w.first + w.times")
    ).select("row", "s.class", "to")
    return plain.unionByName(copies).select("row.*", F.col("to").alias(SHARD), F.col("class.block").alias(BLOCK))


def stored_rows(
    spark: SparkSession, folders: list[tuple[int, str]], path: str, new_path: str,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The distinct rows in the files of a resharded store, with shard, old, block, place and
    times; old is -1 for rewritten files."""
    key = row_key(id_col, text_col)
    left = [(s, *(int(part.split("=")[1]) for part in f.split("/")[-2:])) for s, f in folders if f.startswith(f"{path}/")]
    at = F.broadcast(spark.createDataFrame(left, "shard int, old int, block int"))
    stored = spark.read.parquet(path)
    rows = stored.select(F.col(SHARD).alias("old"), F.col(BLOCK).alias("block"), *named(key)).join(at, ["old", "block"])
    if len(left) < len(folders):
        made = spark.read.parquet(new_path)
        rows = rows.unionByName(made.select(
            F.lit(-1).alias("old"), F.col(BLOCK).alias("block"), F.col(SHARD).alias("shard"), *named(key)
        ))
    classes = rows.groupBy("shard", "old", "block", "doc_id", "size", "text_crc32").agg(F.count("*").alias("times"))
    return classes.withColumns({"place": F.xxhash64("doc_id", "size", "text_crc32"), "first": F.lit(0).cast("bigint")})


def resharded_store(
    docs: DataFrame, shards: int = 24, old_shards: int = 16, cost=stay, block_rows: int = 1_000_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write ``docs`` as a store of ``old_shards`` shards, reshard it, and return every row as
    it is found in the files of the new store: as :func:`reshard` does, but for
    ``old_shard``, which is null for rows of rewritten files. The store stays in the shared
    folder; columns named as its folder levels (``SHARD``, ``BLOCK``) are not stored."""
    spark = docs.sparkSession
    n = docs.count()
    if not n:
        return reshard(docs, shards, old_shards, id_col=id_col, text_col=text_col)
    path, new_path = scratch_path(spark, "store"), scratch_path(spark, "new-store")
    bits = max(4, (n // (old_shards * block_rows)).bit_length())
    write_store(docs, path, old_shards, bits, id_col, text_col)
    folders = reshard_store(spark, path, new_path, shards, old_shards, cost, id_col, text_col)
    rows = written(stored_rows(spark, folders, path, new_path, id_col, text_col), "stored-rows")
    return numbered(rows, shards).withColumn("old_shard", F.expr("nullif(old_shard, -1)"))
