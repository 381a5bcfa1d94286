"""Periodic runs of words: seeds of repeated k-grams, extended along their diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) that no neighbouring word extends with period q, of at least ``min_length``
words and ``min_exponent`` periods. Its words overlap with themselves, moved by q, in at
least o(q) = max(min_length - q, (min_exponent - 1) * q) words.

Index: periods are taken in classes. A class's k is the least overlap o(q) that its
periods guarantee, and it ends where a period would be longer than k. So every run of the
class has the same k-gram at both ends of some lag q <= k.

Pairs: of a document's occurrences of a k-gram only neighbouring ones are paired. That is
enough: within a run with smallest period q <= k a k-gram comes again after exactly q
words, because an earlier return would give the run a smaller period (Fine and Wilf).
For the same reason a pair whose lag is a multiple of the run's period never appears. So
a k-gram that fills a document gives as many pairs as it has places, not their square.

Extension: a pair (i, i + q) is a place on diagonal q; it is extended both ways by exact
word comparison, and a table holds, for each lag, the end of the stretch covered last,
so that the other pairs of a stretch are not extended again.

A document is one row of one task (a run does not cross documents), and nothing is
shuffled. Documents are worked on in batches of ``BATCH`` bytes, a longer one on its own.

Defined results: a null or empty text has no words and no runs; rows with a null id and
repeated rows are documents of their own; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ODD, mixed, shingle_hashes

#: Bytes of text that are indexed at once.
BATCH = 1 << 22
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
Run = tuple[int, int, int]


def period_classes(longest: int, min_length: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """(first period, last period, k) of each class, for documents of ``longest`` words."""
    first = 1
    while first * min_exponent <= longest:
        # From q = min_length on, o(q) only grows.
        k = min(max(min_length - q, (min_exponent - 1) * q) for q in range(first, max(first, min_length) + 1))
        yield first, k, k
        first = k + 1


def neighbours(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place, next place with the same key)."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    among = np.zeros(len(keys), bool)
    among[1:] = same
    among[:-1] |= same
    found = order[among]
    found = found[np.lexsort((places[found], keys[found]))]
    keys, places = keys[found], places[found]
    same = keys[1:] == keys[:-1]
    return places[:-1][same], places[1:][same]


def equal_until(w: np.ndarray, i: int, q: int, end: int) -> int:
    """The first j >= i with w[j] != w[j + q], or the last one that there can be."""
    step = 64
    while i < end - q:
        j = min(i + step, end - q)
        differs = w[i:j] != w[i + q : j + q]
        if differs.any():
            return i + int(differs.argmax())
        i, step = j, step * 2
    return i


def equal_from(w: np.ndarray, i: int, q: int, begin: int) -> int:
    """The least j such that w[j:i] equals w[j + q:i + q]."""
    step = 64
    while i > begin:
        j = max(i - step, begin)
        differs = w[j:i] != w[j + q : i + q]
        if differs.any():
            return i - int(differs[::-1].argmax())
        i, step = j, step * 2
    return i


def find_runs(w: np.ndarray, bounds: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> list[list[Run]]:
    """The runs of each document, by start and then period. ``w`` has the numbers of the
    words of all documents, document d from bounds[d] to bounds[d + 1]."""
    out: list[list[Run]] = [[] for _ in range(len(bounds) - 1)]
    sizes = np.diff(bounds)
    if not len(w):
        return out
    doc = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(bounds[1:], sizes) - np.arange(len(w))  # words from here to the document's end
    values = mixed(w.astype(np.uint64) + np.uint64(1))
    shortest, repeated = 0, None
    for first, last, k in period_classes(int(sizes.max()), min_length, min_exponent):
        fits = left[: max(len(w) - k + 1, 0)] >= k
        if repeated is not None:  # all of the shortest k-grams inside come again, too
            m = k - shortest + 1
            fits &= repeated[m : m + len(fits)] - repeated[: len(fits)] == m
        places = np.flatnonzero(fits)
        if len(places) < 2:
            break
        keys = mixed(shingle_hashes(values, k)[places] + doc[places].astype(np.uint64) * np.uint64(ODD))
        here, there = neighbours(keys, places)
        if repeated is None:
            comes = np.zeros(len(w) + 1, np.int64)
            comes[here + 1] = comes[there + 1] = 1
            shortest, repeated = k, np.cumsum(comes)
        lag = there - here
        at = (lag >= first) & (lag <= last)
        _extend(w, doc, bounds, here[at], lag[at], min_length, min_exponent, out)
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _extend(
    w: np.ndarray, doc: np.ndarray, bounds: np.ndarray, here: np.ndarray, lag: np.ndarray,
    min_length: int, min_exponent: int, out: list[list[Run]],
) -> None:
    """Adds the runs that the pairs (here, here + lag) are seeds of."""
    order = np.lexsort((here, lag))
    here, lag = here[order], lag[order]
    # Of seeds that follow each other on a diagonal the first is enough.
    head = np.ones(len(here), bool)
    head[1:] = (lag[1:] != lag[:-1]) | (here[1:] != here[:-1] + 1)
    covered: dict[int, int] = {}
    for i, q in zip(here[head].tolist(), lag[head].tolist(), strict=True):
        if i < covered.get(q, 0):
            continue
        d = int(doc[i])
        begin, end = int(bounds[d]), int(bounds[d + 1])
        stop = equal_until(w, i, q, end)
        start = equal_from(w, i, q, begin)
        covered[q] = stop
        length = stop - start + q
        if length >= max(min_length, min_exponent * q):
            out[d].append((start - begin, length, q))


def _runs(min_length: int, min_exponent: int, rewrite):
    def batch_of(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        w = np.array([number.setdefault(x, len(number)) for words in texts for x in words], np.int64)
        bounds = np.cumsum([0] + [len(words) for words in texts])
        found = find_runs(w, bounds, min_length, min_exponent)
        kept = []
        for words, runs in zip(texts, found, strict=True):
            if runs:
                keep = np.ones(len(words), bool)
                for start, length, period in runs:
                    keep[start + period : start + length] = False
                words = [x for x, y in zip(words, keep.tolist(), strict=True) if y]
            kept.append(b" ".join(words))
        offsets = np.cumsum([0] + [len(runs) for runs in found])
        flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
        return pa.record_batch({
            "doc_id": pa.array(ids, pa.int64()),
            "n_words": pa.array([len(words) for words in texts], pa.int64()),
            "runs": pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()),
                pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(RUN)),
            ),
            "collapsed_text": pa.array(kept, pa.binary()).cast(pa.string(), safe=False),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[list[bytes]] = []
        size = 0
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            for i, value in zip(batch.column("doc_id").to_pylist(), column, strict=True):
                text = value.as_py() or b""
                if texts and size + len(text) > BATCH:
                    yield batch_of(ids, texts)
                    ids, texts, size = [], [], 0
                words = text.split()
                ids.append(i)
                texts.append(rewrite(i, words) if rewrite else words)
                size += len(text) + 64
        if texts:
            yield batch_of(ids, texts)

    return run


def periodic_runs(
    docs: DataFrame, min_length: int = 6, min_exponent: int = 4,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start word, length and period of
    every run, by start and then period) and collapsed_text (the words but those that a
    run holds after its first period, joined by one space). ``rewrite`` maps a document's
    id and words to the words that are looked at instead; ``min_exponent`` is at least 2."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = (
        "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
        "collapsed_text string"
    )
    return rows.mapInArrow(_runs(min_length, min_exponent, rewrite), schema)


def most_repeated(runs: str = "runs"):
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    def better(a, b):
        mine, other = a["length"] * b["period"], b["length"] * a["period"]
        tie = F.struct(b["start"], b["period"]) < F.struct(a["start"], a["period"])
        return F.when(a.isNull() | (other > mine) | ((other == mine) & tie), b).otherwise(a)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(F.col(runs), none, better)
