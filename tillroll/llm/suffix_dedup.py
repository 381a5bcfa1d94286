"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that starts earlier.

Shards: the suffixes that can share ``length`` bytes have to meet in one shard. The anchor
of a window of ``length`` bytes is the ``gram`` -byte run inside it with the least hash (the
leftmost of equal ones), so equal windows have equal anchors at equal places. The windows of
one anchor make a fragment, at most ``length - gram + 1`` windows long, and fragments are
dealt to shards by the hash of their anchor.

Before that, fragments are compared whole. Of equal fragments only the earliest can hold
a first occurrence; all windows of the others are repeats. That is decided in the task
for the fragments of one batch, so a passage that many documents share is one row a
batch in the shuffle, and then by a sort. Anchors of which a 2^14th of all rows and more
consist are dealt out by fragment, not by anchor; there are at most 2^14 of them.

The fragments that are left, of anchors with several different ones, go to the shards.
A shard's text is their concatenation (bytes 0xFF between them, which UTF-8 never has).
Its suffix array is made by induced sorting and its permuted common prefixes in text
order (``suffix_array``); neighbours that share ``length`` bytes are equal windows, whose
earliest keeps its place. A shard is cut where it has ``SHARD`` bytes, between anchors;
of an anchor with over ``WIDE`` fragments every window is a fragment of its own, compared as
above, so no shard is unbounded.

Order: smaller id, then smaller hash of the text (it orders rows with the same id), then
start. Defined results: a null text is empty; rows with the same id and text are the same
document, and all get its result; rows with a null id neither lose bytes nor count;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, least_of_each, mixed, shingle_hashes, written
from tillroll.llm.suffix_array import permuted_prefixes, suffix_array

U64 = np.uint64
#: Bytes of a shard, and fragments of an anchor that are sorted together.
SHARD, WIDE = 1 << 22, 4096
#: Bytes of a task that makes shards one after the other.
TASK = 1 << 28
#: Bytes of text that are hashed at once, and that are compared within a task.
PIECE, BATCH = 1 << 18, 1 << 25
#: A place is the start of ``n`` windows of the document (doc_id, text_hash).
PLACE = "doc_id bigint, text_hash bigint, start int, n int"
PLACE_FIELDS = [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]
FRAGMENT = f"anchor bigint, content bigint, {PLACE}, many boolean, repeat boolean"


def fragments(text: np.ndarray, left: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, start, number of windows) of the fragments in ``text``, some documents one
    after the other; ``left`` is the bytes from each place to its document's end."""
    none = np.empty(0, np.int64)
    if len(text) < length:
        return none.astype(U64), none, none
    # Unlike word hashes these values are never zero, and each gram has as many.
    grams = mixed(shingle_hashes(_values()[text], gram))
    least = least_of_each(grams, length - gram + 1)
    valid = left[: len(least)] >= length
    # A new one begins with a new document, a new least gram or where the leftmost is left.
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[1:]) | ~valid[:-1]
    starts = np.flatnonzero(new & valid)
    breaks = np.concatenate((np.flatnonzero(new | ~valid), [len(least)]))
    n = breaks[np.searchsorted(breaks, starts, side="right")] - starts
    return least[starts], starts, n


def _values() -> np.ndarray:
    """A value for each byte."""
    if not _VALUES:
        _VALUES.append(mixed(np.arange(257, 513, dtype=U64)))
    return _VALUES[0]


_VALUES: list[np.ndarray] = []


def text_fragments(texts: list[bytes], length: int, gram: int) -> dict[str, np.ndarray]:
    """anchor, content, document's number, start and n of the fragments of ``texts``."""
    out: dict[str, list[np.ndarray]] = {c: [] for c in ("anchor", "content", "row", "start", "n")}
    at = 0
    while at < len(texts):
        first, size = at, 0
        while at < len(texts) and (at == first or size + len(texts[at]) <= PIECE):
            size += len(texts[at])
            at += 1
        piece = b"".join(texts[first:at])
        sizes = np.array([len(x) for x in texts[first:at]])
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(piece))
        anchor, start, n = fragments(np.frombuffer(piece, np.uint8), left, length, gram)
        row = np.searchsorted(ends, start, side="right")
        digest = xxhash.xxh3_64_intdigest
        stops = (start + n + length - 1).tolist()
        content = [digest(piece[a:b]) for a, b in zip(start.tolist(), stops, strict=True)]
        out["anchor"].append(anchor)
        out["content"].append(np.array(content, U64))
        out["row"].append(row + first)
        out["start"].append(start - (ends - sizes)[row])
        out["n"].append(n)
    return {c: np.concatenate(x) if x else np.empty(0, np.int64) for c, x in out.items()}


def compared(found: dict[str, np.ndarray], doc_id: np.ndarray, text_hash: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The fragments of a batch, each content once, at its earliest place; ``many`` marks
    anchors with 16 contents or more. Windows at other places than that are repeats; they
    come as places of as many windows as follow each other."""
    if not len(found["anchor"]):
        return
    doc, text = doc_id[found["row"]], text_hash[found["row"]]
    key = mixed(found["anchor"]) ^ found["content"]
    order = np.argsort(key)
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]]) + 1
    among = np.unique(np.concatenate((again - 1, again)))
    part = order[among]
    part = part[np.lexsort((found["start"][part], text[part], doc[part], key[part]))]
    first = np.ones(len(part), bool)
    first[1:] = key[part[1:]] != key[part[:-1]]
    leader = part[np.maximum.accumulate(np.where(first, np.arange(len(part)), 0))]
    earliest = np.ones(len(key), bool)
    earliest[part] = first
    # A row that is given twice is the same document: it does not repeat itself.
    moved = (doc[part] != doc[leader]) | (text[part] != text[leader]) | (found["start"][part] != found["start"][leader])
    repeat = part[~first & moved]
    repeat = repeat[np.lexsort((found["start"][repeat], found["row"][repeat]))]
    row, start, n = (found[c][repeat] for c in ("row", "start", "n"))
    new = np.ones(len(repeat), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + n[:-1])
    runs = np.flatnonzero(new)
    total = np.add.reduceat(n, runs) if len(runs) else n
    here = np.flatnonzero(earliest)
    _, inverse, counts = np.unique(found["anchor"][here], return_inverse=True, return_counts=True)
    several = np.concatenate((counts[inverse] >= 16, np.zeros(len(runs), bool)))
    at = np.concatenate((here, repeat[runs]))
    yield pa.record_batch({
        "anchor": pa.array(found["anchor"][at].view(np.int64)),
        "content": pa.array(found["content"][at].view(np.int64)),
        "doc_id": pa.array(doc[at]),
        "text_hash": pa.array(text[at]),
        "start": pa.array(found["start"][at].astype(np.int32)),
        "n": pa.array(np.concatenate((found["n"][here], total)).astype(np.int32)),
        "many": pa.array(several),
        "repeat": pa.array(np.arange(len(at)) >= len(here)),
    })


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``most`` bytes of ``column`` each."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _all_fragments(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH):
            doc_id, text_hash = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "text_hash"))
            yield from compared(text_fragments(byte_texts(batch.column("text")), length, gram), doc_id, text_hash)

    return run


def _all_windows(length: int):
    """The windows of the fragments in the rows (text, doc_id, text_hash, start), each a
    fragment of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", PIECE):
            texts = byte_texts(batch.column("text"))
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "text_hash", "start")}
            n = np.array([len(x) - length + 1 for x in texts])
            row = np.repeat(np.arange(len(texts)), n)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            digests = [xxhash.xxh3_128_intdigest(x[i : i + length]) for x in texts for i in range(len(x) - length + 1)]
            yield from compared({
                "anchor": np.array([d >> 64 for d in digests], U64),
                "content": np.array([d & 0xFFFFFFFFFFFFFFFF for d in digests], U64),
                "row": row, "start": columns["start"][row] + offset, "n": np.ones(len(row), np.int64),
            }, columns["doc_id"], columns["text_hash"])

    return run


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the fragments, sorted by (anchor, content, place): as ``repeat`` those after the first
    place of their content, and the first of each content where the anchor has several.
    Of the rows before a batch only the last content's first place is kept."""
    names = [n for n, _ in PLACE_FIELDS]

    def rows(source: pa.RecordBatch, at: np.ndarray, repeat: np.ndarray) -> pa.RecordBatch:
        taken = {n: source.column(n).take(pa.array(at)) for n in ("anchor", *names)}
        return pa.record_batch({**taken, "repeat": pa.array(repeat[at])})

    last = None  # anchor, content and its first place
    contents = 0  # of the last anchor so far
    alone = None  # the row of its only content so far
    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        anchor, content = (batch.column(c).to_numpy() for c in ("anchor", "content"))
        place = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "text_hash", "start")])
        hot = batch.column("hot").to_numpy(zero_copy_only=False)
        new_anchor, new_content = np.ones(size, bool), np.ones(size, bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new_content[1:] = new_anchor[1:] | (content[1:] != content[:-1])
        if last is not None:
            new_anchor[0] = anchor[0] != last[0]
            new_content[0] = new_anchor[0] or content[0] != last[1]
        leader = np.maximum.accumulate(np.where(new_content, np.arange(size), -1))
        first_place = place[:, np.maximum(leader, 0)]
        if last is not None:
            first_place[:, leader < 0] = last[2][:, None]
        repeat = ~new_content & (place != first_place).any(axis=0)
        group = np.cumsum(new_anchor)
        number = np.bincount(group[new_content], minlength=group[-1] + 1)
        number[0] += contents
        if alone is not None and number[0] > 1:
            yield alone
            alone = None
        several = (number > 1)[group] | hot
        yield rows(batch, np.flatnonzero(repeat | (new_content & several)), repeat)
        contents = int(number[group[-1]])
        if group[-1] > 0:
            alone = None
        own = np.flatnonzero(new_content & (group == group[-1]))
        if contents == 1 and len(own) and not hot[own[0]]:
            alone = rows(batch, own[:1], repeat)
        last = (anchor[-1], content[-1], first_place[:, -1])


def classes(found: DataFrame, name: str) -> DataFrame:
    """(anchor, place, repeat) of the fragments that matter: repeats of whole ones, and
    the first of each content of anchors with several."""
    new = found.where("not repeat")
    total = new.count()
    often = new.where("many").groupBy("anchor").agg(F.count("*").alias("rows")).where(F.col("rows") * (1 << 14) >= total)
    dealt = new.drop("many", "repeat").join(
        F.broadcast(often.select(F.col("anchor").alias("often"))), F.col("anchor") == F.col("often"), "left"
    ).withColumn("hot", F.col("often").isNotNull()).drop("often")
    rows = dealt.repartition("anchor", F.when(F.col("hot"), F.col("content"))).sortWithinPartitions(
        "anchor", "content", "doc_id", "text_hash", "start"
    )
    return written(rows.mapInArrow(_classes, f"anchor bigint, {PLACE}, repeat boolean"), name)


def _cut(length: int):
    """(anchor, place, text) of the row's ``places``, structs of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", PIECE):
            texts = byte_texts(batch.column("text"))
            places = batch.column("places")
            flat = places.flatten()
            row = np.repeat(np.arange(len(texts)), np.diff(places.offsets.to_numpy()))
            starts, n = flat.field("start"), flat.field("n")
            stops = starts.to_numpy() + n.to_numpy() + length - 1
            cut = [texts[k][a:b] for k, a, b in zip(row.tolist(), starts.to_pylist(), stops.tolist(), strict=True)]
            yield pa.record_batch({
                "anchor": flat.field("anchor"),
                "wide": flat.field("wide"),
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "text_hash": batch.column("text_hash").take(pa.array(row)),
                "start": starts,
                "n": n,
                "text": pa.array(cut, pa.binary()),
            })

    return run


def shard_repeats(texts: list[bytes], doc_id: np.ndarray, text_hash: np.ndarray, start: np.ndarray, length: int):
    """(fragment, first window, windows) of the runs of windows that an earlier place has,
    from the suffix array of the fragments and its common prefixes."""
    sizes = np.array([len(x) for x in texts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    t = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    order = suffix_array(t)
    common = permuted_prefixes(t, order, starts, sizes, length)
    row = np.repeat(np.arange(len(texts)), sizes + 1)
    offset = np.arange(len(t)) - starts[row]
    window = offset + length <= sizes[row]
    # Neighbours in the suffix array that share ``length`` bytes are the same window.
    whole = window[order]
    joined = whole & (common[order] >= length)
    joined[1:] &= whole[:-1]
    joined[:1] = False
    among = joined.copy()
    among[:-1] |= joined[1:]
    group = np.cumsum(~joined)[among]
    at = order[among]
    r = row[at]
    place = start[r] + offset[at]
    by_place = np.lexsort((place, text_hash[r], doc_id[r], group))
    group, at, place, r = group[by_place], at[by_place], place[by_place], r[by_place]
    first = np.ones(len(at), bool)
    first[1:] = group[1:] != group[:-1]
    leader = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    moved = (doc_id[r] != doc_id[r[leader]]) | (text_hash[r] != text_hash[r[leader]]) | (place != place[leader])
    gone = np.zeros(len(t) + 1, bool)
    gone[at[moved]] = True
    turns = np.flatnonzero(np.diff(np.concatenate(([False], gone))))
    begins, ends = turns[::2], turns[1::2]
    return row[begins], offset[begins], ends - begins


def _shards(length: int):
    def sort(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        doc_id, text_hash, start = (table.column(c).to_numpy() for c in ("doc_id", "text_hash", "start"))
        fragment, first, n = shard_repeats(byte_texts(table.column("text")), doc_id, text_hash, start, length)
        return pa.record_batch({
            "doc_id": pa.array(doc_id[fragment]),
            "text_hash": pa.array(text_hash[fragment]),
            "start": pa.array((start[fragment] + first).astype(np.int32)),
            "n": pa.array(n.astype(np.int32)),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in by_bytes(batches, "text", SHARD >> 3):
            # The last anchor may go on in the next slice; a shard is cut before it.
            anchor = batch.column("anchor").to_numpy()
            if held and size >= SHARD:
                before = held[-1].column("anchor")[-1].as_py()
                cut = int((anchor != before).argmax()) if (anchor != before).any() else len(anchor)
                if cut < len(anchor):
                    yield sort([*held, batch.slice(0, cut)])
                    held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += int(pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0)
        if held:
            yield sort(held)

    return run


def repeats(docs: DataFrame, length: int, gram: int) -> list[DataFrame]:
    """Places whose windows all start earlier too, of the rows (doc_id, text_hash, text)."""
    known = docs.where("doc_id is not null")
    found = written(known.mapInArrow(_all_fragments(length, gram), FRAGMENT), "fragments")
    first = classes(found, "fragment-classes")
    out = [found.where("repeat"), first.where("repeat")]
    kept = first.where("not repeat").drop("repeat")
    wide = kept.groupBy("anchor").agg(F.count("*").alias("contents")).where(F.col("contents") > WIDE)
    marked = kept.join(wide, "anchor", "left").withColumn("wide", F.col("contents").isNotNull())
    places = marked.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("anchor", "start", "n", "wide")).alias("places"))
    cut = written(
        known.join(places, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "places").mapInArrow(
            _cut(length), f"anchor bigint, wide boolean, {PLACE}, text binary"
        ),
        "fragment-texts",
    )
    size, some_wide = cut.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.max("wide")).first()
    shards = cut.where("not wide").select("anchor", "doc_id", "text_hash", "start", "text")
    tasks = min(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD))
    shards = shards.repartition(max(1, tasks, -(-size // TASK)), "anchor").sortWithinPartitions("anchor")
    out.append(written(shards.mapInArrow(_shards(length), PLACE), "shard-repeats"))
    if some_wide:
        windows = written(cut.where("wide").select("doc_id", "text_hash", "start", "text").mapInArrow(_all_windows(length), FRAGMENT), "windows")
        out += [windows.where("repeat"), classes(windows, "window-classes").where("repeat")]
    return [x.select("doc_id", "text_hash", "start", "n") for x in out]


def _removed(length: int):
    """The row's text without the bytes that its ``places`` cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH >> 2):
            texts = byte_texts(batch.column("text"))
            places = batch.column("places")
            flat = places.flatten()
            starts, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "n"))
            bounds = places.offsets.to_numpy()
            bounds = bounds - bounds[0]  # the slice's own values only
            kept, spans, removed = [], [], []
            for k, text in enumerate(texts):
                a, b = int(bounds[k]), int(bounds[k + 1])
                runs = covered(starts[a:b], n[a:b] + length - 1) if a < b else []
                spans.append([{"start": s, "n": e - s} for s, e in runs])
                removed.append(sum(e - s for s, e in runs))
                edges = [0, *(x for run in runs for x in run), len(text)]
                kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)) if runs else text)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(x) for x in texts], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                "kept": pa.array(kept, pa.binary()),
            })

    return run


def covered(starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """The maximal runs (start, end) that the spans cover."""
    order = np.argsort(starts, kind="stable")
    starts = starts[order]
    ends = np.maximum.accumulate(starts + sizes[order])
    new = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1])))
    last = np.concatenate((new[1:] - 1, [len(ends) - 1]))
    return list(zip(starts[new].tolist(), ends[last].tolist(), strict=True))


def suffix_dedup(
    docs: DataFrame, length: int = 100, gram: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, spans (start and size of every
    maximal run of bytes that is removed), kept_sha256 and kept (the remaining bytes)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    found = repeats(rows, length, gram)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    places = every.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "n")).alias("places"))
    none = F.array().cast("array<struct<start: int, n: int>>")
    joined = rows.join(places, ["doc_id", "text_hash"], "left").select("doc_id", "text", F.coalesce("places", none).alias("places"))
    schema = (
        "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, n: bigint>>, "
        "kept_sha256 string, kept binary"
    )
    return joined.mapInArrow(_removed(length), schema)
