"""Token counts without token ids.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens as its
pre-tokens have pieces. The corpus' distinct pre-tokens are counted, each is encoded
once, and the numbers of pieces are joined to each document's pre-token frequencies
and summed.

The join is split by frequency. Pre-tokens with at least 1/``head_share`` of all
occurrences are at most ``head_share``; they go to every task, which adds them up in
place. The rest, the tail, joins by shuffle, where no key is frequent. Both parts are
exact, at every size.

Defined results: a null text counts as empty and has 0 bytes and 0 tokens; every
occurrence of a special token's string is one token, as the library does by default;
rows with the same id stay rows of their own; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, count_rows, counted_batch, frequent, slices, with_row_key, written

# The characters with Unicode's White_Space property, as ranges of a character class
# (fixed by the standard). No pre-token holds one after another character, so a text
# may be cut before every run of them.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: Chunks that a task remembers for certain; those it met since then come on top.
REMEMBERED = 150_000
#: Distinct chunks that a task counts before it sends them on.
COUNTED = 300_000
#: A space starts no word of a chunk that stands for itself.
MARK = " "
# White space other than the space and the line break.
RARE_SPACE = r"\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Chunks whose pre-tokens need no library: a line break, a word of Latin letters with the
# space before it, and a run of ASCII punctuation, each optional but the word. The
# apostrophe is left out, as it may start a contraction.
PLAIN = re.compile(r"(\n)?( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]+)?")


class PreTokens:
    """Cuts texts into chunks, white space followed by a word, and chunks into pre-tokens
    with the library's own pre-tokeniser (but for ``PLAIN`` ones)."""

    def __init__(self, tokenizer_json: str) -> None:
        # Tasks run side by side already; the library's own threads would add memory only.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = [t["content"] for t in json.loads(tokenizer_json)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.find = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.rare = re.compile(f"[{RARE_SPACE}]").search

    def chunks(self, text: str) -> list[str]:
        """Where single spaces are the only cuts but for line breaks inside a word, a word
        stands for itself with a space before it, so the first word, which has none, is
        given with a mark that no chunk starts with."""
        if not text:
            return []
        if "  " in text or " \n" in text or "\n " in text or text[0].isspace() or text[-1].isspace() or self.rare(text):
            return [MARK + c for c in self.find(text)]
        words = text.split(" ")
        words[0] = MARK + words[0]
        return words

    def texts(self, text: str) -> tuple[int, list[str]]:
        """Special tokens in a text, and its chunks."""
        if self.special is None or not self.special.search(text):
            return 0, self.chunks(text)
        parts = self.special.split(text)
        return len(parts) - 1, [c for part in parts for c in self.chunks(part)]

    def of_chunk(self, chunk: str) -> list[bytes]:
        chunk = chunk[len(MARK) :] if chunk.startswith(MARK) else " " + chunk
        plain = PLAIN.fullmatch(chunk)
        if plain:
            return [p.encode() for p in plain.groups() if p]
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)
        return [chunk[a:b].encode() for _, (a, b) in cut]

    def pieces(self, pre_tokens: list[bytes]) -> list[int]:
        """The number of tokens of each pre-token."""
        encoded = self.tokenizer.encode_batch([p.decode() for p in pre_tokens], add_special_tokens=False)
        return [len(e.ids) for e in encoded]


def _texts(column: pa.Array) -> list[str]:
    return [b.decode("utf-8", "replace") for b in byte_texts(column)]


def pre_token_counts(texts: DataFrame, tokenizer_json: str) -> DataFrame:
    """(key, n) of every distinct pre-token of ``texts`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = PreTokens(tokenizer_json)

        def emit(chunks: Counter) -> pa.RecordBatch:
            found: dict[bytes, int] = {}
            for chunk, n in chunks.items():
                for p in cut.of_chunk(chunk):
                    found[p] = found.get(p, 0) + n
            return counted_batch(found)

        yield from count_rows(
            slices(batches), lambda batch: (cut.texts(t)[1] for t in _texts(batch.column("text"))), emit, COUNTED
        )

    return texts.mapInArrow(run, "key binary, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def piece_counts(counts: DataFrame, tokenizer_json: str) -> DataFrame:
    """``counts`` with the number of pieces of each key, each encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = PreTokens(tokenizer_json)
        for batch in slices(batches, 4096):
            pieces = cut.pieces(batch.column("key").to_pylist())
            yield pa.record_batch({
                "key": batch.column("key"), "n": batch.column("n"), "pieces": pa.array(pieces, pa.int32()),
            })

    return counts.mapInArrow(run, "key binary, n bigint, pieces int")


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, head_share: int = 1 << 20,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit. The tokenizer file
    is read by the driver and sent along, so only the driver needs the path."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(piece_counts(pre_token_counts(rows.select("text"), tokenizer_json), tokenizer_json), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    head = dict(frequent(pieces, total, head_share, "key", "pieces"))
    in_head = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, known = PreTokens(tokenizer_json), in_head.value
        # Chunk -> pieces of its known pre-tokens, with the unknown ones if any. Chunks met
        # since the last turn are taken over, so that frequent ones are cut only once.
        recent: dict = {}
        older: dict = {}
        for batch in slices(batches):
            if len(recent) > REMEMBERED:
                recent, older = {}, recent
            base, sizes, keys, times, rows = [], [], [], [], []
            column = byte_texts(batch.column("text"))
            for k, text in enumerate(column):
                total, chunks = cut.texts(text.decode("utf-8", "replace"))
                rest: dict[bytes, int] = {}
                for chunk, n in Counter(chunks).items():
                    got = recent.get(chunk)
                    if got is None:
                        got = older.get(chunk)
                        if got is None:
                            parts = cut.of_chunk(chunk)
                            new = [p for p in parts if p not in known]
                            got = sum(known.get(p, 0) for p in parts)
                            if new:
                                got = got, new
                        recent[chunk] = got
                    if type(got) is int:
                        total += n * got
                        continue
                    total += n * got[0]
                    for p in got[1]:
                        rest[p] = rest.get(p, 0) + n
                base.append(total)
                sizes.append(len(rest))
                keys += rest.keys()
                times += rest.values()
            if not column:
                continue
            # The row's own line, whose key is one that no pre-token has (they aren't
            # empty), and differs from row to row, so that these lines are spread.
            at = np.repeat(np.arange(len(sizes)), sizes)
            row = batch.column("__row")
            own = [b"0" + str(r).encode() for r in row.to_pylist()]
            yield pa.record_batch({
                "__row": pa.concat_arrays([row, row.take(pa.array(at))]),
                "key": pa.array(own + [b"1" + x for x in keys], pa.binary()),
                "times": pa.array([0] * len(own) + times, pa.int64()),
                "base": pa.array(base + [0] * len(keys), pa.int64()),
                "doc_id": pa.concat_arrays([batch.column("doc_id"), pa.nulls(len(keys), batch.column("doc_id").type)]),
                "n_bytes": pa.array([len(t) for t in column] + [None] * len(keys), pa.int64()),
            })

    kind = rows.schema["doc_id"].dataType.simpleString()
    frequencies = with_row_key(rows).mapInArrow(
        run, f"__row bigint, key binary, times bigint, base bigint, doc_id {kind}, n_bytes bigint"
    )
    tail = pieces.select(F.concat(F.lit(b"1"), F.col("key")).alias("key"), "pieces")
    summed = frequencies.join(tail, "key", "left").groupBy("__row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("base") + F.coalesce(F.col("times") * F.col("pieces"), F.lit(0))).alias("n_tokens"),
    )
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
