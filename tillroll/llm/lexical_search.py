"""Ranked lexical search by the Best Position Algorithm.

Score of a document for an item: the sum over the item's terms of the term's weight
times a saturated frequency, in whole numbers (``impact``). Weights and lengths are
relative to all documents; both come from one pass that writes, for each document, its
number of terms and the frequencies of the items' terms in it (its postings).

Documents are searched in blocks, each in one task. A block has an impact list for
each term: its documents by falling impact. For an item the lists of its terms are read
from the top at the same pace. Every document met is looked up in the other lists
(direct access), which gives its whole score and its places there; each list keeps track
of its best position, the last of the places 1, 2, ... without a gap that were seen either
way. A document not yet met lies below all best positions, so its score is at most the
sum of the impacts there. The search stops when this sum is strictly below the score
in ``k``-th place, so that documents that tie with it are all seen, or when the lists end.
As direct accesses count as seen, the sum falls faster than that of the last places read.

The ``k`` best of each block are compared in Spark. Blocks are bounded by documents and
postings, so their lists fit a task whatever the corpus. The items go to every task, in
blocks of at most ``ITEM_WORDS`` words (a longer item is a block by itself), one after the
other.

Defined results: a null text has no term, and neither it nor an empty one counts in N;
rows with a null id count as documents and come after others among equal scores;
repeated rows are documents of their own; items with a null id are left out, and items
with the same id are separate queries; items without a term, or whose terms no
document has, give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, slices, written

#: Bytes that belong to terms, in lower case, and a space for all others.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
#: Words of items that are broadcast at once.
ITEM_WORDS = 1 << 18
#: Documents and postings of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 1 << 22
#: Places read from each list before the first and, doubled, the next comparison.
FIRST_STEP = 16


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def _postings(numbers: dict[bytes, int]):
    """(doc_id, n, terms, tfs) of each document: the items' terms that it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, at, terms, tfs = [], [0], [], []
            for text in byte_texts(batch.column("text")):
                words = terms_of(text)
                n.append(len(words))
                counts = Counter(map(numbers.get, words))
                counts.pop(None, None)
                terms.extend(counts.keys())
                tfs.extend(counts.values())
                at.append(len(terms))
            offsets = pa.array(at, pa.int32())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n": pa.array(n, pa.int64()),
                "terms": pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                "tfs": pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
            })

    return run


def weight_of(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Weight times saturated frequency, all in 64-bit whole numbers."""
    m = 25 + (75 * n * n_docs) // n_terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Block:
    """The impact lists of one block of documents."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, docs: np.ndarray, values: np.ndarray, n_lists: int) -> None:
        """A posting is (term, number of the document in the block, impact); by document."""
        self.ids = ids
        by_term = np.argsort(terms, kind="stable")
        self.bounds = np.searchsorted(terms[by_term], np.arange(n_lists + 1))
        #: Of each list the documents in rising order, with their impacts ...
        self.docs, self.values = docs[by_term], values[by_term]
        by_impact = np.lexsort((-self.values, terms[by_term]))
        #: ... and by falling impact; ``place`` leads from the first order to the second.
        self.top_docs, self.top_values = self.docs[by_impact], self.values[by_impact]
        self.place = np.empty(len(by_impact), np.int64)
        self.place[by_impact] = np.arange(len(by_impact))
        self.place -= np.repeat(self.bounds[:-1], np.diff(self.bounds))
        self.met = np.zeros(len(ids), bool)
        self.score = np.zeros(len(ids), np.int64)

    def search(self, terms: list[int], times: list[int], k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(document, score) of the k best with a score above 0, by score and id, and
        how many documents were met."""
        lists = [(int(self.bounds[t]), int(self.bounds[t + 1]), c) for t, c in zip(terms, times, strict=True)]
        lists = [x for x in lists if x[0] < x[1]]
        seen = [np.zeros(end - begin, bool) for begin, end, _ in lists]
        best = [0] * len(lists)
        met: list[np.ndarray] = []
        depth, step = 0, FIRST_STEP
        while True:
            read = [self.top_docs[begin + depth : min(begin + depth + step, end)] for begin, end, _ in lists]
            new = np.unique(np.concatenate([*read, np.empty(0, np.int64)]))
            new = new[~self.met[new]]
            self.met[new] = True
            met.append(new)
            bound = 0
            for j, (begin, end, c) in enumerate(lists):
                if best[j] == end - begin:
                    continue
                # Direct accesses: the new documents' places in this list.
                docs = self.docs[begin:end]
                at = np.searchsorted(docs, new)
                here = at < len(docs)
                here[here] = docs[at[here]] == new[here]
                at = at[here]
                self.score[new[here]] += c * self.values[begin + at]
                seen[j][self.place[begin + at]] = True
                rest = seen[j][best[j] :]
                gap = int(rest.argmin())
                best[j] = end - begin if rest[gap] else best[j] + gap
                if best[j] < end - begin:
                    bound += c * int(self.top_values[begin + best[j] - 1])
            depth, step = depth + step, step * 2
            every = np.concatenate(met)
            scores = self.score[every]
            if bound == 0 or (len(every) >= k and bound < np.partition(scores, len(scores) - k)[len(scores) - k]):
                break
        found = every[scores > 0]
        order = np.lexsort((self.ids[found], -self.score[found]))[:k]
        found = found[order]
        out = found, self.score[found], len(every)
        self.met[every] = False
        self.score[every] = 0
        return out


#: Sorts after all ids; only used inside blocks.
NO_ID = np.iinfo(np.int64).max


def _search(items: list[tuple[int, list[int], list[int]]], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """(item, doc_id, score) of the k best documents of each block."""

    def search(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        doc_ids = table.column("doc_id").combine_chunks()
        lists = table.column("terms").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        n = table.column("n").to_numpy()
        terms = lists.flatten().to_numpy()
        docs = np.repeat(np.arange(len(n)), sizes)
        tf = table.column("tfs").combine_chunks().flatten().to_numpy()
        values = impacts(weights[terms], tf, n[docs], n_docs, n_terms)
        ids = doc_ids.fill_null(NO_ID).to_numpy()
        block = Block(ids, terms, docs, values, len(weights))
        at: list[int] = []
        found: list[np.ndarray] = [np.empty(0, np.int64)]
        scores: list[np.ndarray] = [np.empty(0, np.int64)]
        for number, item_terms, times in items:
            best, score, _ = block.search(item_terms, times, k)
            at += [number] * len(best)
            found.append(best)
            scores.append(score)
        yield pa.record_batch({
            "item": pa.array(at, pa.int64()),
            "doc_id": doc_ids.take(pa.array(np.concatenate(found))),
            "score": pa.array(np.concatenate(scores)),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        docs = postings = 0
        for batch in slices(batches):
            held.append(batch)
            docs += batch.num_rows
            postings += len(batch.column("terms").flatten())
            if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                yield from search(held)
                held, docs, postings = [], 0, 0
        if held:
            yield from search(held)

    return run


def _best_of(found: DataFrame, k: int) -> DataFrame:
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """(item_id, terms of the item with their times), in blocks of ``ITEM_WORDS`` words."""
    block: list[tuple] = []
    words = 0
    for row in items.toLocalIterator():
        terms = Counter(terms_of((row["text"] or "").encode()))
        if block and words + len(terms) > ITEM_WORDS:
            yield block
            block, words = [], 0
        block.append((row["item_id"], terms))
        words += len(terms)
    if block:
        yield block


def lexical_search(
    docs: DataFrame, items: DataFrame, k: int = 10,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` documents with the highest score above 0 of each item, or all if there are
    fewer: item_id, rank (from 1, without ties; equal scores by id), doc_id, score."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    queries = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text")).where("item_id is not null")
    results = None
    for block in item_blocks(queries):
        found = _search_block(rows, block, k).withColumnRenamed("rank", "place")
        names = rows.sparkSession.createDataFrame(
            [(i, item_id) for i, (item_id, _) in enumerate(block)], f"item bigint, item_id {queries.schema['item_id'].dataType.simpleString()}"
        )
        result = found.join(F.broadcast(names), "item").select("item_id", F.col("place").cast("int").alias("rank"), "doc_id", "score")
        results = result if results is None else results.unionByName(result)
    if results is None:
        results = queries.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    return results


def _search_block(rows: DataFrame, block: list[tuple], k: int) -> DataFrame:
    """(item, rank, doc_id, score), written, of the items of a block, by their numbers."""
    numbers = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
    postings = written(
        rows.mapInArrow(_postings(numbers), "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"), "postings"
    )
    n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    weights = np.zeros(max(len(numbers), 1), np.int64)
    for term, df in held:
        weights[term] = weight_of(n_docs, df)
    queries = [(i, [numbers[t] for t in terms], list(terms.values())) for i, (_, terms) in enumerate(block)]
    found = postings.where(F.size("terms") > 0).mapInArrow(
        _search(queries, weights, n_docs, max(n_terms, 1), k), "item bigint, doc_id bigint, score bigint"
    )
    return written(_best_of(found, k), "best-documents")
