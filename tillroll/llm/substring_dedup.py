"""Substring dedup by seed and extend.

Seeds: of the ``seed`` -word runs inside each window of ``length`` words, the one with
the least hash is the window's anchor (winnowing). Equal windows have equal anchors at
equal places, so every repeat of ``length`` words shares one. Documents are joined on
anchors that more than one document has.

Extension: the windows that share an anchor are the ways to extend it to ``length`` words
or more, up to the next anchor on either side; together they are its reach. Where
another document with a smaller id has an anchor with the same reach, the repeat goes on
over all of it. Where the reaches of an anchor differ, a repeat begins or ends there, and
the reach's windows are compared one by one, once for each distinct reach (by its
holder with the least id; the others are repeats already). Overlapping windows are
merged to maximal repeats, which are at least ``length`` words long.

Only the least holder of a reach or window matters, so holders are reduced to a minimum
before the shuffle and no pair of documents is ever made: a passage that a third of all
documents share is one row per task. The joins back to documents are sort-merge joins,
whose skewed sides Spark splits. Anchors, reaches and windows are compared by 64-bit hashes,
the latter two together with their anchor's.

Defined results: a null text has no words; a text with fewer words than ``length`` has
no window; rows with a null id neither lose words nor count as holders; rows with the
same id do not count as each other's holders, repeated rows included; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, least_of_each, mixed, shingle_hashes, slices, word_hashes, written

U64 = np.uint64


def windows(text: bytes, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor and the hash of every window of ``length`` words."""
    h = word_hashes(text)
    if len(h) < length:
        return np.empty(0, U64), np.empty(0, U64)
    anchors = least_of_each(mixed(shingle_hashes(h, seed)), length - seed + 1)
    return anchors, shingle_hashes(h ^ U64(0x5851F42D4C957F2D), length)


def reaches(anchors: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of windows with one anchor begins, and a hash of its windows."""
    if not len(anchors):
        return np.empty(0, np.int64), anchors
    starts = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(anchors)])))
    place = (np.arange(len(anchors)) - np.repeat(starts, sizes)).astype(U64)
    return starts, mixed(np.add.reduceat(mixed(found + place * U64(0x9E3779B97F4A7C15)), starts))


def hash_rows(found: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.record_batch({n: pa.array(c.view(np.int64)) for n, c in zip(names, columns, strict=True)})


def distinct(first: np.ndarray, second: np.ndarray, doc_id: int) -> tuple:
    """The distinct pairs of a document, with its id."""
    _, at = np.unique(mixed(first) ^ second, return_index=True)
    return first[at], second[at], np.full(len(at), doc_id, np.int64)


def _all_reaches(length: int, seed: int):
    """(anchor, reach, doc_id) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            found = []
            for i, text in zip(ids, byte_texts(batch.column("text")), strict=True):
                a, w = windows(text, length, seed)
                starts, r = reaches(a, w)
                found.append(distinct(a[starts], r, i))
            yield hash_rows(found, ("anchor", "reach", "doc_id"))

    return run


def _windows_of_edges(length: int, seed: int):
    """(anchor, window, doc_id) of every window in the row's ``edges``, pairs of anchor and
    reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            found = []
            for k, text in enumerate(byte_texts(batch.column("text"))):
                a, w = windows(text, length, seed)
                starts, r = reaches(a, w)
                at = held(a[starts], r, batch.column("edges")[k].values, "reach")
                within = np.repeat(at, np.diff(np.concatenate((starts, [len(a)])))) if len(a) else at
                found.append(distinct(a[within], w[within], ids[k]))
            yield hash_rows(found, ("anchor", "window", "doc_id"))

    return run


def held(anchors: np.ndarray, values: np.ndarray, pairs: pa.StructArray, name: str) -> np.ndarray:
    """Which (anchor, value) are among the pairs."""
    of_anchor, of_value = (pairs.field(c).to_numpy(zero_copy_only=False).view(U64) for c in ("anchor", name))
    known = set(zip(of_anchor.tolist(), of_value.tolist(), strict=True))
    out = np.zeros(len(anchors), bool)
    for i in np.flatnonzero(np.isin(values, of_value)).tolist():
        out[i] = (int(anchors[i]), int(values[i])) in known
    return out


def _removed(length: int, seed: int):
    """The row's words without those that its repeats cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_text": [], "spans": []}
            for k, text in enumerate(byte_texts(batch.column("text"))):
                words = text.split()
                keep, spans, kept = None, [], words
                runs, singles = batch.column("reaches")[k], batch.column("windows")[k]
                if (runs.is_valid or singles.is_valid) and len(words) >= length:
                    a, w = windows(text, length, seed)
                    gone = np.zeros(len(a), bool)
                    if runs.is_valid:
                        starts, r = reaches(a, w)
                        at = held(a[starts], r, runs.values, "value")
                        gone = np.repeat(at, np.diff(np.concatenate((starts, [len(a)]))))
                    if singles.is_valid:
                        gone |= held(a, w, singles.values, "value")
                    edge = np.zeros(len(words) + 1, np.int64)
                    first = np.flatnonzero(gone)
                    edge[first] += 1
                    edge[first + length] -= 1
                    keep = np.cumsum(edge[:-1]) == 0
                    turn = np.flatnonzero(np.diff(np.concatenate(([True], keep, [True]))))
                    spans = [{"start": int(b), "n": int(e - b)} for b, e in turn.reshape(-1, 2)]
                    kept = [x for x, y in zip(words, keep.tolist(), strict=True) if y]
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_text"].append(b" ".join(kept))
                out["spans"].append(spans)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in out["kept_text"]], pa.string()),
                "kept_text": pa.array(out["kept_text"], pa.binary()).cast(pa.string(), safe=False),
                "spans": pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))),
            })

    return run


def least_holders(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))


def repeats(rows: DataFrame, length: int, seed: int) -> DataFrame:
    """(doc_id, reaches, windows) of the documents with a window that a document with a
    smaller id has; rows: (doc_id long, text)."""
    known = rows.where("doc_id is not null")
    seeds = known.mapInArrow(_all_reaches(length, seed), "anchor bigint, reach bigint, doc_id bigint")
    shared = least_holders(seeds, "anchor").where("least < most").select("anchor")
    joined = written(seeds.join(shared, "anchor").select("anchor", "reach", "doc_id"), "shared-anchors")
    classes = written(least_holders(joined, "anchor", "reach"), "reaches")
    # A reach that a document with a smaller id has: a repeat as a whole.
    whole = joined.join(classes.where("least < most"), ["anchor", "reach"]).where("least < doc_id")
    whole = whole.groupBy("doc_id").agg(F.collect_set(F.struct("anchor", F.col("reach").alias("value"))).alias("reaches"))
    # Anchors with several reaches: the windows of each, by its least holder.
    several = classes.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    edges = classes.join(several, "anchor").groupBy(F.col("least").alias("doc_id")).agg(
        F.collect_list(F.struct("anchor", "reach")).alias("edges")
    )
    single = written(
        known.join(edges, "doc_id").select("doc_id", "text", "edges").mapInArrow(
            _windows_of_edges(length, seed), "anchor bigint, window bigint, doc_id bigint"
        ),
        "edge-windows",
    )
    least = least_holders(single, "anchor", "window").where("least < most")
    part = single.join(least, ["anchor", "window"]).where("least < doc_id")
    part = part.groupBy("doc_id").agg(F.collect_set(F.struct("anchor", F.col("window").alias("value"))).alias("windows"))
    return written(whole.join(part, "doc_id", "full"), "repeats")


def substring_dedup(
    docs: DataFrame, length: int = 13, seed: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept_text (the
    kept words joined by one space) and spans (start word and length of every maximal
    repeat)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    found = repeats(rows, length, seed).withColumnRenamed("doc_id", "__id")
    joined = rows.join(found, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", "reaches", "windows")
    schema = (
        "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string, "
        "spans array<struct<start: int, n: int>>"
    )
    return joined.mapInArrow(_removed(length, seed), schema)
