"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to powers of ``base``. The filter holds
each n-gram once for every level up to its own; a count is read back by probing level
after level until a probe misses.

What is held. Every word and every pair of neighbouring words of the training rows, at
every size of the corpus (``share`` and ``context_share`` leave rare ones out, and are not
set by default). The filter is a table of blocks, each for a range of the n-grams' hashes.
Their number follows from the tokens and the types, and a block's bits from its n-grams,
``bits_each`` for an insertion (``expected_error``). Blocks are built in tasks, and no
task, nor the driver, has more than one of them at a time. As a filter of all n-grams grows
with the corpus it is joined by shuffles and not broadcast.

Lookups. Documents are read in chunks of about ``CHUNK`` tokens. A chunk sends each block
the distinct keys it asks for, by a shuffle on the block, and gets their levels back by one
on the chunk; a key is asked for once by a chunk, however frequent. A block probes the keys of
many chunks at a time.

Probability. P(w) takes the held count of w; words not held share the remaining mass
evenly over all types the filter lacks, unseen ones as one more type. P(w | u) =
weight * low(u w) / high(u) + (1 - weight * mass(u)) * P(w): low and high are ends of
the quantised level, and mass(u) is the sum of low / high over the held pairs of u, so
the probabilities of all words after u add up to one, false positives aside. The first
token of a text has nothing before it and takes P(w). The levels and masses of contexts
are kept in the blocks of their words, by hash, and so are the exact counts.

The exact part of the result (known tokens, add-one base score) takes these counts: a word's
answer has them beside its level. Words are told apart by 64 bits of hash.

Defined results: null and empty texts hold the end token only; with no training rows
all counts are zero; rows with the same id stay rows of their own; a null id is never
in training nor held out; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillroll.llm.common import (
    byte_texts, count_rows, fold_remainder, intermediates, mixed, slices, with_row_key, word_hashes, written,
)

U64 = np.uint64
#: The end of a text; no word is empty. Hashes of the end, and of the start as a context.
END = b""
END_HASH = U64(0x9FB21C651E98DF25)
START = U64(0x2545F4914F6CDD1D)


def tokens_of(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


def token_hashes(text: bytes) -> np.ndarray:
    return np.append(word_hashes(text.lower()), END_HASH)


def key_hashes(keys: list[bytes]) -> np.ndarray:
    """Hashes of tokens, in any order."""
    out = np.full(len(keys), END_HASH)
    out[[bool(k) for k in keys]] = word_hashes(b" ".join(k for k in keys if k))
    return out


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * U64(0x9E3779B97F4A7C15) + second)


@dataclass
class LogFrequencyFilter:
    """Bloom filter of (n-gram hash, level) for levels 0 to the n-gram's own."""

    bits: np.ndarray
    hashes: int
    top: int

    @classmethod
    def built(cls, keys: np.ndarray, levels: np.ndarray, bits: int, hashes: int) -> LogFrequencyFilter:
        out = cls(np.zeros(bits // 8, np.uint8), hashes, int(levels.max(initial=-1)) + 1)
        for level in range(out.top):
            some = keys[levels >= level]
            for i in range(hashes):
                place = out._place(some, level, i)
                np.bitwise_or.at(out.bits, place >> U64(3), np.uint8(1) << (place & U64(7)).astype(np.uint8))
        return out

    def _place(self, keys: np.ndarray, level: int, i: int) -> np.ndarray:
        step = U64((level * self.hashes + i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return ((mixed(keys ^ step) >> U64(32)) * U64(len(self.bits) * 8)) >> U64(32)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level held of each key, -1 for none: probes go on while all hit."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level in range(self.top):
            for i in range(self.hashes):
                place = self._place(keys[left], level, i)
                left = left[(self.bits[place >> U64(3)] >> (place & U64(7)).astype(np.uint8)) & 1 > 0]
            if not len(left):
                break
            out[left] = level
        return out

    def expected_error(self, insertions: int) -> float:
        return (1 - math.exp(-self.hashes * insertions / (len(self.bits) * 8))) ** self.hashes


#: Occurrences of pairs, and words, that a block is made for; tokens of a chunk; least bits.
PAIRS_IN_BLOCK, WORDS_IN_BLOCK, CHUNK, LEAST_BITS = 1 << 20, 1 << 17, 1 << 18, 1 << 16
#: Keys that a block probes at a time.
PROBED = 1 << 18
#: An answer to a word: its level, its level as a context (-1 for none), the context's mass and
#: the word's exact count.
WORD = np.dtype([("level", "i1"), ("context", "i1"), ("mass", "<f8"), ("count", "<f8")])
CONTEXT = np.dtype([("key", "<u8"), ("level", "i1"), ("mass", "<f8"), ("count", "<f8")])
BLOCK = "block int, bits binary, top int, contexts binary"


def block_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The block of each key, of ``n``; it grows with the key."""
    return (((keys >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def packed(keys: np.ndarray) -> bytes:
    """The low 40 bits of each key, which tell keys of one block apart."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel().astype(U64)


def pair_keys(pairs: np.ndarray, n: int) -> np.ndarray:
    """What a pair is looked up by: its block of ``n``, and the low 32 bits of its hash, which
    in a block err far less often than the filter."""
    return (block_of(pairs, n).astype(U64) << U64(32)) | (pairs & U64(0xFFFFFFFF))


def squeezed(keys: np.ndarray) -> bytes:
    """Rising 32-bit numbers: their steps, byte by byte of all, compressed."""
    steps = np.diff(keys.astype("<u4"), prepend=np.uint32(0)).astype("<u4")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(keys).to_bytes(4, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def unsqueezed(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[4:], 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=U64)


def runs(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, begin, end) of each run of equal values."""
    if not len(sorted_values):
        return []
    begin = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return [(int(sorted_values[b]), int(b), int(e)) for b, e in zip(begin, [*begin[1:], len(sorted_values)], strict=True)]


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of their values."""
    keys, back = np.unique(keys, return_inverse=True)
    return keys, np.bincount(back, values, len(keys))


def table_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield tuple(c[at].as_py() for c in batch.columns)


@dataclass
class Model:
    blocks: DataFrame | None  # BLOCK: those of words, then those of pairs
    word_blocks: int
    pair_blocks: int
    tokens: int
    types: int
    base: float
    weight: float
    unheld: float  # P of each type that is not held
    held_total: float  # counts as read back plus the mass of types not held
    hashes: int

    def parts(self) -> dict:
        """The model without its blocks, as plain values that a task can hold without this module."""
        return vars(self) | {"blocks": None}

    def questions(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct words and distinct pairs; the word before each token (START at ``starts``),
        and its pair."""
        before = np.roll(words, 1)
        before[starts] = START
        pair = pair_keys(pair_hashes(before, words), self.pair_blocks)
        return np.unique(np.append(words, START)), np.unique(pair), before, pair

    def asked(self, each: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The blocks that are asked, in order, and their keys, in order."""
        for block, begin, end in runs(block_of(each, self.word_blocks)):
            yield block, each[begin:end]
        for block, begin, end in runs(pairs >> U64(32)):
            yield self.word_blocks + block, pairs[begin:end] & U64(0xFFFFFFFF)

    def sent(self, block: int, keys: np.ndarray) -> bytes:
        return keys.astype("<u8").tobytes() if block < self.word_blocks else squeezed(keys)

    def received(self, block: int, data: bytes) -> np.ndarray:
        return np.frombuffer(data, "<u8").astype(U64) if block < self.word_blocks else unsqueezed(data)

    def answer(self, block: int, row: tuple, keys: np.ndarray) -> np.ndarray:
        """Of the block ``row`` (bits, top, contexts) to ``keys`` as received, key by key."""
        bits, top, contexts = row
        level = LogFrequencyFilter(np.frombuffer(bits, np.uint8), self.hashes, top).levels(keys).astype(np.int8)
        if block >= self.word_blocks:
            return level
        held = np.frombuffer(contexts, CONTEXT)
        out = np.zeros(len(keys), WORD)
        out["level"], out["context"] = level, -1
        if len(held):
            at = np.minimum(np.searchsorted(held["key"], keys), len(held) - 1)
            same = held["key"][at] == keys
            for name, of in (("context", "level"), ("mass", "mass"), ("count", "count")):
                out[name][same] = held[of][at[same]]
        return out

    def probabilities(self, each: np.ndarray, pair_level: np.ndarray, word, pair, before) -> np.ndarray:
        """log10 P of each token, from the answers for distinct words and pairs."""
        level = each["level"].astype(float)
        p = np.where(level < 0, self.unheld, self.base**level * math.sqrt(self.base) / self.held_total)[word]
        context, level = each[before], pair_level[pair].astype(float)
        low = np.where(level < 0, 0.0, self.base**level)
        high = self.base ** (context["context"] + 1.0)
        known = self.weight * np.minimum(low / high, 1.0) + (1 - self.weight * context["mass"]) * p
        return np.log10(np.where(context["context"] >= 0, known, p))

    def log10(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 P of each token given the one before; those at ``starts`` follow START. For
        a few words: the blocks that they need come to the driver."""
        each, pairs, before, pair = self.questions(words, starts)
        places = [np.searchsorted(*x) for x in ((each, words), (pairs, pair), (each, before))]
        asked = list(self.asked(each, pairs))
        rows = self.blocks.where(F.col("block").isin([b for b, _ in asked])).collect()
        held = {r["block"]: (bytes(r["bits"]), r["top"], bytes(r["contexts"])) for r in rows}
        got = [(b, self.answer(b, held[b], self.received(b, self.sent(b, keys))).tobytes()) for b, keys in asked]
        return self.probabilities(*answers(got, self.word_blocks), *places)


def answers(got: list[tuple[int, bytes]], word_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Answers of all blocks, in order, as those to words and those to pairs."""
    return (
        np.frombuffer(b"".join(a for b, a in got if b < word_blocks), WORD),
        np.frombuffer(b"".join(a for b, a in got if b >= word_blocks), np.int8),
    )


def levels_of(n: np.ndarray, base: float) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / math.log(base) + 1e-9).astype(np.int64)


def built_block(block: int, keys: np.ndarray, levels: np.ndarray, bits_each: int, hashes: int, contexts: bytes) -> dict:
    bits = max(LEAST_BITS, -(-int((levels + 1).sum()) * bits_each // 8) * 8)
    held = LogFrequencyFilter.built(keys, levels, bits, hashes)
    return {"block": block, "bits": held.bits.tobytes(), "top": held.top, "contexts": contexts}


def token_rows(rows: DataFrame) -> DataFrame:
    """(key, n) of every distinct token of ``rows`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from count_rows(slices(batches), lambda batch: map(tokens_of, byte_texts(batch.column("text"))))

    return rows.mapInArrow(run, "key binary, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def pair_parts(rows: DataFrame, n_blocks: int) -> DataFrame:
    """Partial counts of pairs: (block, keys, first, n), of many pairs of a block in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def emptied():
            first, second = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            keys, at, n = np.unique(pair_hashes(first, second), return_index=True, return_counts=True)
            first, block = first[at], block_of(keys, n_blocks)
            # Equal words side by side compress well.
            order = np.lexsort((first, block))
            keys, first, n = keys[order], first[order].astype("<u8"), n[order].astype("<u4")
            cuts = runs(block)
            return pa.record_batch({
                "block": pa.array([v for v, _, _ in cuts], pa.int32()),
                "keys": pa.array([packed(keys[b:e]) for _, b, e in cuts], pa.binary()),
                "first": pa.array([first[b:e].tobytes() for _, b, e in cuts], pa.binary()),
                "n": pa.array([n[b:e].tobytes() for _, b, e in cuts], pa.binary()),
            })

        for batch in slices(batches):
            for text in byte_texts(batch.column("text")):
                h = token_hashes(text)
                held.append((h[:-1], h[1:]))
                size += len(h) - 1
                if size >= 1 << 19:
                    yield emptied()
                    size = 0
        if size:
            yield emptied()

    return rows.mapInArrow(run, "block int, keys binary, first binary, n binary")


def pair_blocks(parts: DataFrame, word_blocks: int, least: float, base: float, bits_each: int, hashes: int) -> DataFrame:
    """BLOCK of the pairs, and with null bits what they add to the masses of contexts: (block
    of the context, keys, sums)."""

    def masses(held: list[tuple]) -> pa.RecordBatch:
        first, sums = summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        cuts = runs(block_of(first, word_blocks))
        rows = [
            {"block": v, "keys": first[b:e].astype("<u8").tobytes(), "sums": sums[b:e].astype("<f8").tobytes()}
            for v, b, e in cuts
        ]
        return pa.RecordBatch.from_pylist(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for block, group in groupby(table_rows(batches), key=lambda r: r[0]):
            _, keys, first, n = zip(*group, strict=True)
            keys = unpacked(b"".join(keys))
            first = np.frombuffer(b"".join(first), "<u8").astype(U64)
            n = np.frombuffer(b"".join(n), "<u4").astype(np.int64)
            order = np.lexsort((first, keys))
            keys, first, n = keys[order], first[order], n[order]
            new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (first[1:] != first[:-1]))))
            n = np.add.reduceat(n, new)
            keys, first, n = keys[new][n >= least], first[new][n >= least], n[n >= least]
            levels = levels_of(n, base)
            made = built_block(word_blocks + block, keys & U64(0xFFFFFFFF), levels, bits_each, hashes, b"")
            yield pa.RecordBatch.from_pylist([made | {"keys": None, "sums": None}], schema)
            held.append(summed(first, base**levels.astype(float)))
            size += len(held[-1][0])
            if size >= 1 << 19:
                yield masses(held)
                held, size = [], 0
        if size:
            yield masses(held)

    schema = pa.schema([
        ("block", pa.int32()), ("bits", pa.binary()), ("top", pa.int32()), ("contexts", pa.binary()), ("keys", pa.binary()),
        ("sums", pa.binary()),
    ])
    dealt = parts.repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, f"{BLOCK}, keys binary, sums binary")


def word_blocks_of(
    counts: DataFrame, masses: DataFrame, n_blocks: int, least: float, context_least: float, base: float, bits_each: int,
    hashes: int,
) -> DataFrame:
    """BLOCK of the words of ``counts`` (key, n); ``masses`` (block, keys, sums)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = key_hashes(batch.column("key").to_pylist())
            block = block_of(keys, n_blocks)
            order = np.argsort(block, kind="stable")
            keys, n = keys[order].astype("<u8"), batch.column("n").to_numpy()[order].astype("<f8")
            cuts = runs(block[order])
            yield pa.record_batch({
                "block": pa.array([v for v, _, _ in cuts], pa.int32()), "kind": pa.array([0] * len(cuts), pa.int32()),
                "keys": pa.array([keys[b:e].tobytes() for _, b, e in cuts], pa.binary()),
                "sums": pa.array([n[b:e].tobytes() for _, b, e in cuts], pa.binary()),
            })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, group in groupby(table_rows(batches), key=lambda r: r[0]):
            rows = list(group)
            keys, n = (b"".join(r[c] for r in rows if r[1] == 0) for c in (2, 3))
            keys, n = summed(np.frombuffer(keys, "<u8").astype(U64), np.frombuffer(n, "<f8"))
            first, sums = (b"".join(r[c] for r in rows if r[1] == 1) for c in (2, 3))
            first, sums = summed(np.frombuffer(first, "<u8").astype(U64), np.frombuffer(sums, "<f8"))
            levels = levels_of(n, base)
            mass = np.zeros(len(keys))
            mass[np.searchsorted(keys, first)] = sums
            mass /= base ** (levels + 1.0)
            context = np.zeros(len(keys), CONTEXT)
            context["key"], context["level"], context["mass"], context["count"] = keys, levels, mass, n
            context["level"][n < context_least] = -1
            held = n >= least
            yield pa.RecordBatch.from_pylist(
                [built_block(block, keys[held], levels[held], bits_each, hashes, context.tobytes())], schema
            )

    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary()), ("top", pa.int32()), ("contexts", pa.binary())])
    parts = counts.select("key", "n").mapInArrow(hashed, "block int, kind int, keys binary, sums binary")
    both = parts.unionByName(masses.withColumn("kind", F.lit(1)))
    return both.repartition("block").sortWithinPartitions("block").mapInArrow(run, BLOCK)


def train(
    rows: DataFrame, share: int | None = None, context_share: int | None = None, base: float = 2.0, weight: float = 0.3,
    bits_each: int = 10, hashes: int = 6,
) -> tuple[Model, DataFrame]:
    """The model of ``rows`` (text), and the exact counts (key, n) it was made from. Where they
    are given, n-grams with under 1/``share`` of the tokens are not held, and words with
    under 1/``context_share`` are no contexts."""
    counts = written(token_rows(rows), "token-counts")
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least, context_least = (tokens / s if s else 1.0 for s in (share, context_share))
    level = F.floor(F.log(F.col("n").cast("double")) / math.log(base) + 1e-9)
    held_types, held_tokens, read_back = counts.where(F.col("n") >= least).agg(
        F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.pow(F.lit(base), level)), F.lit(0.0))
    ).first()
    n_words, n_pairs = max(1, -(-types // WORDS_IN_BLOCK)), max(1, -(-tokens // PAIRS_IN_BLOCK))
    with intermediates(rows.sparkSession) as own:
        made = written(pair_blocks(pair_parts(rows, n_pairs), n_words, least, base, bits_each, hashes), "pair-blocks")
        masses = made.where(F.col("bits").isNull()).select("block", "keys", "sums")
        words = written(word_blocks_of(counts, masses, n_words, least, context_least, base, bits_each, hashes), "word-blocks")
        pairs = written(made.where(F.col("bits").isNotNull()).select(*words.columns), "pair-bits")
        del own[1:]  # only the first table goes: the masses are of no more use
    blocks = words.unionByName(pairs)
    rest = float(tokens - held_tokens) + 1.0
    total = read_back * math.sqrt(base) + rest
    model = Model(
        blocks, n_words, n_pairs, int(tokens), int(types), base, weight, rest / total / (types + 1 - held_types), total, hashes
    )
    return model, counts


def chunk_state(sizes: list[int], words: np.ndarray) -> bytes:
    """The numbers of tokens of a chunk's rows, and its words: the distinct ones, frequent ones
    first, and the places among them, byte by byte of all."""
    each, at, n = np.unique(words, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(each), "<u4")
    rank[order] = np.arange(len(each))
    head = np.array([len(sizes), len(each), len(words), *sizes], "<i8").tobytes()
    places = np.ascontiguousarray(rank[at].view(np.uint8).reshape(-1, 4).T).tobytes()
    return head + each[order].astype("<u8").tobytes() + pa.Codec("zstd").compress(places, asbytes=True)


def chunk_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m, size = np.frombuffer(data, "<i8", 3).tolist()
    sizes = np.frombuffer(data, "<i8", n, 24)
    each = np.frombuffer(data, "<u8", m, 24 + 8 * n).astype(U64)
    places = pa.Codec("zstd").decompress(data[24 + 8 * n + 8 * m :], 4 * size, asbytes=True)
    places = np.ascontiguousarray(np.frombuffer(places, np.uint8).reshape(4, size).T).view("<u4").ravel()
    return sizes, each[places]


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (__row, doc_id, held_out, text) with n_tokens, n_known, base_score, score."""
    plain = model.parts()
    unit = model.tokens + model.types + 1
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The chunks: their rows and words."""
        held: list[np.ndarray] = []
        ids, held_out, first = [], [], None

        def chunk() -> pa.RecordBatch:
            made = pa.record_batch({
                "chunk": pa.array([first], pa.int64()),
                "data": pa.array([chunk_state([len(h) for h in held], np.concatenate(held))], pa.binary()),
                "ids": pa.array([ids], pa.list_(id_type)), "held": pa.array([held_out], pa.list_(pa.bool_())),
            })
            for x in (held, ids, held_out):
                x.clear()
            return made

        size = 0
        for batch in slices(batches, 256):
            columns = (batch.column(c).to_pylist() for c in ("__row", "doc_id", "held_out"))
            for row, doc_id, out, text in zip(*columns, byte_texts(batch.column("text")), strict=True):
                if not held:
                    first = row
                held.append(token_hashes(text))
                ids.append(doc_id)
                held_out.append(out)
                size += len(held[-1])
                if size >= CHUNK:
                    yield chunk()
                    size = 0
        if held:
            yield chunk()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The questions of chunks to blocks."""
        lm = Model(**plain)
        for chunk, data in table_rows(batches):
            sizes, words = chunk_of(data)
            each, pairs, *_ = lm.questions(words, np.cumsum([0, *sizes])[:-1])
            asked = list(lm.asked(each, pairs))
            yield pa.record_batch({
                "block": pa.array([b for b, _ in asked], pa.int32()), "chunk": pa.array([chunk] * len(asked), pa.int64()),
                "data": pa.array([lm.sent(*q) for q in asked], pa.binary()),
            })

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of blocks to chunks; a block's row comes before the questions to it, and a block
        without an n-gram has no row."""
        lm, none = Model(**plain), (bytes(LEAST_BITS // 8), 0, b"")
        held, at = none, -1
        waiting: list[tuple[int, np.ndarray]] = []

        def answered() -> pa.RecordBatch:
            got = lm.answer(at, held, np.concatenate([keys for _, keys in waiting]))
            ends = np.cumsum([len(keys) for _, keys in waiting]).tolist()
            made = pa.record_batch({
                "chunk": pa.array([c for c, _ in waiting], pa.int64()), "block": pa.array([at] * len(waiting), pa.int32()),
                "data": pa.array([got[b:e].tobytes() for b, e in zip([0, *ends], ends)], pa.binary()),
            })
            waiting.clear()
            return made

        size = 0
        for block, chunk, data, top, contexts in table_rows(batches):
            if waiting and (block != at or size >= PROBED):
                yield answered()
                size = 0
            if block != at:
                held, at = none, block
            if chunk < 0:
                held = data, top, contexts
            else:
                waiting.append((chunk, lm.received(block, data)))
                size += len(waiting[-1][1])
        if waiting:
            yield answered()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = Model(**plain)
        for _, group in groupby(table_rows(batches), key=lambda r: r[0]):
            (_, _, state, ids, held_out), *got = group
            sizes, words = chunk_of(state)
            starts = np.cumsum([0, *sizes])[:-1]
            each, pairs, before, pair = lm.questions(words, starts)
            word, *others = (np.searchsorted(*x) for x in ((each, words), (pairs, pair), (each, before)))
            of_words, of_pairs = answers([g[1:3] for g in got], lm.word_blocks)
            count = of_words["count"][word]
            p = lm.probabilities(of_words, of_pairs, word, *others)
            yield pa.record_batch({
                "doc_id": pa.array(ids, id_type), "held_out": pa.array(held_out, pa.bool_()),
                "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                "base_score": pa.array(np.add.reduceat(np.log10((count + 1) / unit), starts)),
                "score": pa.array(np.add.reduceat(p, starts)),
            })

    # Written without their questions, which are made again where they are shuffled.
    chunks = written(
        rows.mapInArrow(cut, f"chunk bigint, data binary, ids array<{kind}>, held array<boolean>"), "lm-chunks"
    )
    blocks = model.blocks.select("block", F.lit(-1).cast("bigint").alias("chunk"), F.col("bits").alias("data"), "top", "contexts")
    questions = chunks.select("chunk", "data").mapInArrow(ask, "block int, chunk bigint, data binary")
    dealt = blocks.unionByName(questions, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "chunk")
    # Written, so that the questions' shuffle goes before the chunks' own.
    got = written(dealt.mapInArrow(answer, "chunk bigint, block int, data binary"), "lm-answers")
    both = chunks.select("chunk", F.lit(-1).alias("block"), "data", "ids", "held").unionByName(got, allowMissingColumns=True)
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", "block")
    result = dealt.mapInArrow(
        scored, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return result.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )


def lm_scores(docs: DataFrame, folds: int = 7, fold: int = 2, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per row of ``docs``; learned from those whose id's crc32 modulo ``folds`` is
    not ``fold``."""
    left_out = fold_remainder(id_col, folds)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (left_out == fold).alias("held_out"), F.col(text_col).alias("text"),
        (left_out != fold).alias("__train"),
    )
    model, _ = train(rows.where(F.col("__train") & F.col("doc_id").isNotNull()).select("text"), **how)
    return score(with_row_key(rows.drop("__train")), model)
