"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so Jaccard similarity hides containment. Items
are partitioned by size: class c holds those of up to u = 2**c distinct shingles and
more than half as many. For a class, a document's shingles are read in windows of 2u,
one every u, so that a passage as long as an item lies in one. A window holds at most 2u
shingles, which turns the containment t looked for into a least Jaccard similarity j =
t / (2u / (u / 2) + 1 - t), the same for every class; with one MinHash a band, the number
of bands follows from j and the chance of a miss (``bands``). An item is a candidate of
a document if any MinHash of a window equals the item's. Candidates are then verified:
the share of the item's word shingles that the whole document has, compared as text,
must be at least t.

A window can only have an item's minimum if it holds the shingle that the minimum comes
from, so windows without any of these are passed over without computing minima.

The items' signatures and texts go to every task, in blocks of at most ``block`` shingles;
every block is set against all documents. Documents are read once a block and not
shuffled.

An item of fewer words than a shingle has one shingle, all its words, and is contained where
these follow each other in a document; such runs are looked up by their hash in all
documents, at each length that such items have, and then compared as text.

Defined results: words are lower-cased in A-Z; null and empty items and texts match nothing; items
with a null id are not searched for; repeated items and repeated rows each give their
pairs; other columns are kept as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillroll.llm.common import WORD_PATTERN, byte_texts, mixed, shingle_hashes, slices, word_hashes, word_shingles

U64 = np.uint64
#: Entries of the table that tells at once that a shingle is no item's minimum.
SCREEN = 1 << 20


def bands(share: float, miss: float = 1e-6) -> int:
    """MinHashes of a signature: a window with the least similarity stays unfound with at
    most the chance ``miss``."""
    least = share / (4 + 1 - share)
    return math.ceil(math.log(miss) / math.log(1 - least))


def hashed(text: bytes, n: int) -> np.ndarray:
    """Hashes of the shingles of a text, lower-cased in A-Z."""
    words = word_hashes(text.lower())
    return mixed(shingle_hashes(words, min(n, len(words)))) if len(words) else words


class ItemIndex:
    """Signatures of items by size class, and their shingles."""

    def __init__(self, items: list[tuple[int, bytes]], n: int, share: float) -> None:
        self.n, self.share = n, share
        self.ids = [i for i, _ in items]
        self.shingles = [set(word_shingles(t.lower().split(), n)) for _, t in items]
        self.seeds = mixed(np.arange(1, bands(share) + 1, dtype=U64))
        rows = []
        short: dict[int, dict[int, list[int]]] = {}
        for at, (_, text) in enumerate(items):
            words = len(text.split())
            own = np.unique(hashed(text, n))
            if 0 < words < n:
                short.setdefault(words, {}).setdefault(int(own[0]), []).append(at)
            elif words:
                size = max(len(own) - 1, 0).bit_length()
                signature = mixed(own[:, None] ^ self.seeds[None, :])
                least = signature.argmin(axis=0)
                rows += [(int(own[p]), size, k, int(signature[p, k]), at) for k, p in enumerate(least.tolist())]
        #: Of items of fewer than ``n`` words, by that number: sorted hashes, and the items of each.
        self.short = {m: (np.array(sorted(found), U64), found) for m, found in short.items()}
        rows.sort()
        self.shingle = np.array([r[0] for r in rows], U64)
        self.size, self.band = (np.array([r[c] for r in rows], np.int64) for c in (1, 2))
        self.least = np.array([r[3] for r in rows], U64)
        self.item = np.array([r[4] for r in rows], np.int64)
        self.screen = np.zeros(SCREEN, bool)
        self.screen[self.shingle & U64(SCREEN - 1)] = True

    def candidates(self, shingles: np.ndarray) -> set[int]:
        """Places of the items of which a window of the document has a MinHash."""
        if not len(self.shingle):
            return set()
        at = np.flatnonzero(self.screen[shingles & U64(SCREEN - 1)])
        if not len(at):
            return set()
        first = np.searchsorted(self.shingle, shingles[at], "left")
        last = np.searchsorted(self.shingle, shingles[at], "right")
        size = last - first
        if not size.any():
            return set()
        place = np.repeat(at, size)
        entry = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        found: set[int] = set()
        # The windows of an entry's class that hold the place: one or two, each once.
        step = 1 << self.size[entry]
        last_window = np.maximum(-(-len(shingles) // step) - 2, 0)
        tried = {
            (int(e), int(w))
            for back in (0, 1)
            for e, w in zip(entry, np.clip(place // step - back, 0, last_window), strict=True)
        }
        for e, w in sorted(tried):
            item = int(self.item[e])
            if item not in found:
                u = 1 << int(self.size[e])
                window = shingles[w * u : w * u + 2 * u]
                if mixed(window ^ self.seeds[self.band[e]]).min() == self.least[e]:
                    found.add(item)
        return found

    def short_candidates(self, words: np.ndarray) -> dict[int, set[int]]:
        """By number of words, places of short items that a run of the document's hashes as."""
        out: dict[int, set[int]] = {}
        for m, (hashes, items) in self.short.items():
            runs = mixed(shingle_hashes(words, m))
            at = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
            for h in np.unique(runs[hashes[at] == runs]).tolist():
                out.setdefault(m, set()).update(items[h])
        return out

    def matches(self, text: bytes) -> list[tuple[int, int]]:
        """(place of an item, shingles of it that the text has) of contained items."""
        words = word_hashes(text.lower())
        found = self.candidates(mixed(shingle_hashes(words, self.n)))
        by_length = {self.n: found, **self.short_candidates(words)} if self.short else {self.n: found}
        out = []
        for m, places in by_length.items():
            if places:
                own = set(word_shingles(text.lower().split(), m))
                counted = [(i, len(self.shingles[i] & own)) for i in places]
                out += [(i, c) for i, c in counted if c >= self.share * len(self.shingles[i]) - 1e-9]
        return sorted(out)


def item_blocks(items: DataFrame, block: int) -> Iterator[list[tuple[int, bytes]]]:
    """Blocks of (item_id, text) of about ``block`` words at most; items: (item_id, text)."""
    items = items.where("item_id is not null and text is not null")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(WORD_PATTERN)))).first()[0] or 0
    n = -(-words // block)
    for k in range(n):
        got = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "text").toArrow()
        yield list(zip(got.column("item_id").to_pylist(), byte_texts(got.column("text")), strict=True))


def contained_items(
    docs: DataFrame, items: DataFrame, n: int = 5, share: float = 0.8, block: int = 1 << 19,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, shared, size, containment) of every row of ``docs`` that has at least
    ``share`` of the distinct shingles of an item (items: item_id, text)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind, item_kind = rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, shared bigint, size bigint, containment double"
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    parts = [rows.mapInArrow(_pairs(docs, b, n, share, item_type), schema) for b in item_blocks(items, block)]
    out = docs.sparkSession.createDataFrame([], schema)
    for part in parts:
        out = part if len(parts) == 1 else out.unionByName(part)
    return out


def _pairs(docs: DataFrame, items: list, n: int, share: float, item_type: pa.DataType):
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(shared.value, n, share)
        for batch in slices(batches):
            at, item, common, size = [], [], [], []
            for k, text in enumerate(byte_texts(batch.column("text"))):
                for i, c in index.matches(text):
                    at.append(k)
                    item.append(index.ids[i])
                    common.append(c)
                    size.append(len(index.shingles[i]))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(at, pa.int32())),
                "item_id": pa.array(item, item_type),
                "shared": pa.array(common, pa.int64()), "size": pa.array(size, pa.int64()),
                "containment": pa.array([c / s for c, s in zip(common, size, strict=True)], pa.float64()),
            })

    return run


def decontaminated(
    docs: DataFrame, items: DataFrame, n: int = 5, share: float = 0.8, block: int = 1 << 19, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    out = docs
    for some in item_blocks(items, block):
        out = _without(out, some, n, share, text_col)
    return out


def _without(docs: DataFrame, items: list, n: int, share: float, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(shared.value, n, share)
        for batch in slices(batches):
            clean = [not index.matches(t) for t in byte_texts(batch.column(place))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
