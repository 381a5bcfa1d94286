"""Helpers shared by the text operators: words, hashes, written intermediates and
the head/tail split of per-document lookups."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import remove_path, scratch_path

# Words of the contracts: maximal runs of bytes other than space and \x09-\x0D.
# ``bytes.split()`` splits at exactly those six bytes, and ``bytes.lower()``
# changes A-Z only, so tasks work on the UTF-8 bytes without decoding them.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting to delete a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Paths that ``written`` made, one list for each ``intermediates`` that is open.
_MADE: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Collects the paths that ``written`` makes inside, and removes those that are left in the
    list at the end; on an error they stay."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE.remove(made)
    for path in made:
        remove_path(spark, path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lineage cut that survives
    lost executors. The shuffle files behind it are of no more use and go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for made in _MADE:
        made.append(path)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def fold_remainder(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; -1 for a null id."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % n, F.lit(-1)).cast("int")


def least_hashed(rows: DataFrame, n: int, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows with the least hash ``h`` (a 64-bit number) of ``rows``, of which there
    are about ``n``. Only rows below a bound that about ``k`` hashes are below are sorted, so
    that not every task sends ``k`` of them. With fewer than ``n`` hashes there may be fewer rows."""
    some = rows
    share = (k + 8 * math.sqrt(k) + 100) / max(n, 1)
    if share < 0.5:
        some = rows.where(F.col("h") < int(share * 2.0**64) - (1 << 63))
    return some.orderBy("h", *ties).limit(k)


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b or b"" for b in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Smaller batches, which bound what a task builds from one of them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 steps), element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of text that are hashed at once; longer words have a hash of their own kind.
PIECE = 1 << 15
ODD = 0x9E3779B97F4A7C15
_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """White space, values of bytes (0 for white space), powers of ODD and their inverses."""
    if not _TABLES:
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        values = np.where(space, np.uint64(0), mixed(np.arange(1, 257, dtype=np.uint64)))
        powers = np.full((2, PIECE), 1, np.uint64)
        powers[:, 1:] = np.array([[ODD], [pow(ODD, -1, 1 << 64)]], np.uint64)
        _TABLES.extend([space, values, *np.cumprod(powers, axis=1, dtype=np.uint64)])
    return _TABLES


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of ``text.split()``: a polynomial in its bytes' values."""
    if len(text) <= PIECE:
        return _piece_hashes(text)
    out, begin = [], 0
    while begin < len(text):
        end = min(len(text), begin + PIECE)
        if end < len(text):
            last = max(text.rfind(s, begin, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if last < 0:  # one word goes on over the whole piece
                space = re.compile(rb"[ \t-\r]").search(text, end)
                end = space.start() if space else len(text)
                if end - begin > PIECE:
                    out.append(np.array([xxhash.xxh3_64_intdigest(text[begin:end])], np.uint64))
                    begin = end
                    continue
            else:
                end = last + 1
        out.append(_piece_hashes(text[begin:end]))
        begin = end
    return np.concatenate(out)


def _piece_hashes(text: bytes) -> np.ndarray:
    spaces, values, powers, inverses = _tables()
    b = np.frombuffer(text, np.uint8)
    # Padded by a space on either side, a word begins and ends where this changes.
    space = np.ones(len(b) + 2, bool)
    np.take(spaces, b, out=space[1:-1])
    turn = np.flatnonzero(space[1:] != space[:-1])
    if not len(turn):
        return np.empty(0, np.uint64)
    starts, ends = turn[::2], turn[1::2]
    total = np.add.reduceat(values[b] * powers[: len(b)], starts)
    return mixed(total * inverses[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` consecutive word hashes, the polynomial in them;
    none if there are fewer. Runs of twice the length are made from two runs."""
    size = len(words) - n + 1
    if size < 1:
        return np.empty(0, np.uint64)
    out, done, run, length = None, 0, words, 1
    while True:
        if n & length:
            if out is None:
                out = run[:size]
            else:
                out = out * np.uint64(pow(ODD, length, 1 << 64)) + run[done : done + size]
            done += length
        if 2 * length > n:
            return out
        run = run[:-length] * np.uint64(pow(ODD, length, 1 << 64)) + run[length:]
        length *= 2


def least_of_each(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each run of ``n`` consecutive values."""
    size = len(values) - n + 1
    length = 1
    while 2 * length <= n:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    return np.minimum(values[:size], values[n - length : n - length + size])


def word_shingles(words: list[bytes], n: int) -> list[bytes]:
    """``n``-word shingles; a text of fewer words has one, its whole sequence."""
    if not words:
        return []
    return [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]


def with_row_key(df: DataFrame, name: str = "__row") -> DataFrame:
    """A key for each row, so that rows with the same id stay apart. It follows from
    the scan's partition and the row's place in it, so a repeated task makes the
    same keys; it is used within one plan only."""
    return df.withColumn(name, F.monotonically_increasing_id())


def count_rows(parts: Iterable[pa.RecordBatch], lists, emit=None, most: int = 120_000) -> Iterator[pa.RecordBatch]:
    """Counts of the items of ``lists(batch)``, combined inside the task. When a table has
    ``most`` items it is sent on, as (key binary, n long) or as ``emit`` makes it."""
    emit = emit or counted_batch
    held: Counter = Counter()
    for batch in parts:
        for items in lists(batch):
            held.update(items)
            if len(held) >= most:
                yield emit(held)
                held = Counter()
    if held:
        yield emit(held)


def counted_batch(held: dict[bytes, int]) -> pa.RecordBatch:
    return pa.record_batch({"key": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})


def frequent(counts: DataFrame, total: int, share: int, *columns: str) -> list[tuple]:
    """The rows of ``counts`` (key, n, ...) whose n is at least total / ``share``.

    There are at most ``share`` of them whatever the corpus, as their counts add up to
    no more than ``total``; longer keys than 64 bytes are left to the join. So the
    result is bounded and may go to the driver and to every task."""
    rows = counts.where((F.col("n") * share >= total) & (F.length("key") <= 64)).select(*columns)
    table = rows.toArrow()
    return list(zip(*(table.column(c).to_pylist() for c in columns), strict=True))
