"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>) over the distinct hashed terms i
of a text. The factors give pairs of terms a weight of their own, such as an insult
next to the mention of a group, which a linear model can't express.

The model is fitted on the driver to at most ``max_rows`` labelled rows (those with the
least hash of their id), of which only hashed terms are fetched. Terms enter it if they
are in at least ``min_rows`` of these rows and their frequencies in the two classes
differ by ``min_z`` standard errors, so that long texts don't drown the few words that
tell; or if they are in a pair of terms that tells, though each alone may not: the product
of their centred presences and the centred label differs from 0 by ``min_pair_z`` standard
errors (``telling_pairs``). A pair is looked at if one of its terms is among the
``max_pair_terms`` most telling ones of the frequent ones and chance alone puts the two
together in 5 texts, so the other may be rare. The model is at most ``max_terms`` rows of
1 + ``factors`` numbers and goes to every task; every whole text is scored. Texts are held as
numbers of their terms only, and tables by tiles.

Defined results: null and empty texts are scored by their lack of terms; a null id is
scored and is neither held out nor in training; of several labels of one id the
highest counts; rows with the same id stay rows of their own; with no usable labels
all scores are 0; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, fold_remainder, least_hashed, slices

TERM = r"[^\W\d_]+"


class Terms(dict):
    """Hashed place of each term, remembered; emptied beyond ``bound`` terms."""

    def __init__(self, size: int, bound: int = 150_000) -> None:
        super().__init__()
        self.size, self.bound, self.find = size, bound, re.compile(TERM).findall

    def __missing__(self, term: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        place = self[term] = xxhash.xxh3_64_intdigest(term) % self.size
        return place

    def of(self, text: bytes) -> set[int]:
        return {self[t] for t in set(self.find(text.decode("utf-8", "replace").lower()))}


@dataclass
class Machine:
    places: np.ndarray  # sorted hashed terms of the model
    w0: float
    w: np.ndarray
    v: np.ndarray

    def rows_of(self, texts: list[set[int]]) -> tuple[np.ndarray, np.ndarray]:
        """(text, model row) of every known term."""
        sizes = [len(t) for t in texts]
        flat = np.fromiter((x for t in texts for x in t), np.int64, sum(sizes))
        text = np.repeat(np.arange(len(texts)), sizes)
        if not len(self.places):
            return text[:0], flat[:0]
        at = np.minimum(np.searchsorted(self.places, flat), len(self.places) - 1)
        known = self.places[at] == flat
        return text[known], at[known]

    def margins(self, text: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The margin of ``n`` texts and the sum of their factors."""
        total = np.zeros((n, self.v.shape[1]))
        np.add.at(total, text, self.v[term])
        linear = np.bincount(text, self.w[term] - 0.5 * (self.v[term] ** 2).sum(axis=1), n)
        return self.w0 + linear + 0.5 * (total**2).sum(axis=1), total

    def scores(self, texts: list[set[int]]) -> np.ndarray:
        margin, _ = self.margins(*self.rows_of(texts), len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def counted(flat: np.ndarray, n: int, weights: np.ndarray | None = None, step: int = 1 << 20) -> np.ndarray:
    """How often (or with what weight) each number below ``n`` is in ``flat``, piece by piece."""
    out = np.zeros(n)
    for at in range(0, len(flat), step):
        out += np.bincount(flat[at : at + step], None if weights is None else weights[at : at + step], n)
    return out


def telling_pairs(
    text: np.ndarray, term: np.ndarray, labels: np.ndarray, rows: np.ndarray, z: np.ndarray, min_z: float, most: int
) -> np.ndarray:
    """Which terms are in a pair that tells. Term i is in ``rows``[i] texts and tells by ``z``[i]
    alone; of the terms in at least sqrt(5 n) of the n texts the ``most`` telling ones are paired
    with all terms that chance puts together with them in at least 5 texts."""
    n = len(labels)
    out = np.zeros(len(rows), bool)
    often = np.flatnonzero((rows**2 >= 5.0 * n) & (rows < n))
    often = np.sort(often[np.argsort(-z[often], kind="stable")[:most]])
    if not len(often):
        return out
    others = np.flatnonzero((rows * rows[often].max() >= 5.0 * n) & (rows < n))
    number = np.full(len(rows), -1, np.int32)
    number[others] = np.arange(len(others))
    known = number[term] >= 0
    # The texts of each of the other terms, term by term.
    held, of = number[term[known]], text[known]
    order = np.argsort(held, kind="stable")
    held, of = held[order], of[order]
    starts = np.searchsorted(held, np.arange(len(others) + 1))
    share = rows / n
    deviation = np.sqrt(share * (1 - share))
    off = labels - labels.mean()
    for begin in range(0, len(often), 128):
        tile = often[begin : begin + 128]
        x = np.zeros((n, len(tile)), np.float32)
        for k, t in enumerate(tile.tolist()):
            a, b = starts[number[t]], starts[number[t] + 1]
            x[of[a:b], k] = 1
        x -= share[tile].astype(np.float32)
        x *= off[:, None].astype(np.float32)
        whole = x.sum(axis=0)
        # So many terms at a time that they have about 2^17 places.
        at = 0
        while at < len(others):
            end = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 17), side="right")) - 1)
            some = others[at:end]
            total = np.add.reduceat(x[of[starts[at] : starts[end]]], starts[at:end] - starts[at], axis=0)
            total -= share[some, None] * whole
            error = np.outer(deviation[some], deviation[tile]) * np.sqrt(n * labels.var())
            told = (np.abs(total) >= min_z * error) & (error > 0) & (np.outer(rows[some], rows[tile]) >= 5.0 * n)
            told &= some[:, None] != tile
            out[some] |= told.any(axis=1)
            out[tile] |= told.any(axis=0)
            at = end
    return out


def fit(texts: list[set[int]], labels: np.ndarray, **how) -> Machine:
    """:func:`fit_flat` of the texts' terms one after the other."""
    sizes = np.array([len(t) for t in texts], np.int64)
    return fit_flat(np.fromiter((x for t in texts for x in t), np.int32, int(sizes.sum())), sizes, labels, **how)


def fit_flat(
    flat: np.ndarray, sizes: np.ndarray, labels: np.ndarray, factors: int = 8, min_rows: int = 5, min_z: float = 4.0,
    min_pair_z: float = 6.0, max_pair_terms: int = 1024, max_terms: int = 20_000, epochs: int = 30, rate: float = 0.1,
    decay: float = 1e-4, seed: int = 7,
) -> Machine:
    """AdaGrad on the logistic loss of minibatches. Text i has the next sizes[i] numbers of
    ``flat``, none twice."""
    rng = np.random.default_rng(seed)
    n1 = float(labels.sum())
    n0 = len(labels) - n1
    if not n1:
        return Machine(np.empty(0, np.int64), -40.0, np.empty(0), np.empty((0, factors)))
    n_places = int(flat.max(initial=-1)) + 1
    of_text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    both = counted(flat, n_places)
    in1 = counted(flat, n_places, labels[of_text])
    share = (both + 1) / (len(labels) + 2)
    z = np.abs(in1 / n1 - (both - in1) / max(n0, 1)) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / max(n0, 1)))
    z[both < min_rows] = 0
    pairs = telling_pairs(of_text, flat, labels, np.where(both >= min_rows, both, 0.0), z, min_pair_z, max_pair_terms)
    z[pairs] += min_z
    chosen = np.sort(np.argsort(-z, kind="stable")[:max_terms])
    places = chosen[z[chosen] >= min_z].astype(np.int64)
    m = Machine(places, float(np.log(n1 / max(n0, 1))), np.zeros(len(places)), rng.normal(0, 0.01, (len(places), factors)))
    row_of = np.full(n_places, -1, np.int32)
    row_of[places] = np.arange(len(places))
    known = row_of[flat] >= 0
    text, term = of_text[known], row_of[flat[known]]
    starts = np.searchsorted(text, np.arange(len(sizes) + 1))
    g0, gw, gv = 1e-8, np.full(len(places), 1e-8), np.full(m.v.shape, 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(sizes))
        for at in range(0, len(order), 256):
            some = order[at : at + 256]
            size = starts[some + 1] - starts[some]
            pick = np.repeat(starts[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
            row, col = np.repeat(np.arange(len(some)), size), term[pick]
            margin, total = m.margins(row, col, len(some))
            off = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[some]
            d0 = off.mean()
            dw = np.bincount(col, off[row], len(places)) / len(some) + decay * m.w
            dv = np.zeros(m.v.shape)
            np.add.at(dv, col, off[row, None] * (total[row] - m.v[col]))
            dv = dv / len(some) + decay * m.v
            g0, gw, gv = g0 + d0**2, gw + dw**2, gv + dv**2
            m.w0 -= rate * d0 / np.sqrt(g0)
            m.w -= rate * dw / np.sqrt(gw)
            m.v -= rate * dv / np.sqrt(gv)
    return m


def train(
    docs: DataFrame, labels: DataFrame, folds: int, fold: int, size: int, max_rows: int, **how
) -> Machine:
    """docs: (doc_id, text); labels: (doc_id, label). Rows whose id's crc32 modulo ``folds``
    is ``fold`` are not used."""
    usable = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (fold_remainder("doc_id", folds) != fold))
    one = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = least_hashed(one.withColumn("h", F.xxhash64("doc_id")), one.count(), max_rows, "doc_id").drop("h")
    # At most max_rows ids and labels.
    rows = docs.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(size)
        for batch in slices(batches):
            found = [sorted(terms.of(t)) for t in byte_texts(batch.column("text"))]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "terms": pa.array(found, pa.list_(pa.int32())),
            })

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {kind}, label double, terms array<int>")
    # Rows with one id are few texts of it; the first in the order of terms is taken.
    got = made.groupBy("doc_id", "label").agg(F.min("terms").alias("terms")).orderBy("doc_id").toArrow()
    if not got.num_rows:
        return fit([], np.empty(0), **how)
    terms = got.column("terms").combine_chunks()
    sizes = np.diff(terms.offsets.to_numpy()).astype(np.int64)
    return fit_flat(terms.flatten().to_numpy(), sizes, got.column("label").to_numpy().astype(float), **how)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, size: int = 1 << 18, max_rows: int = 12_000,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **how,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    machine = docs.sparkSession.sparkContext.broadcast(vars(train(rows, known, folds, fold, size, max_rows, **how)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, m = Terms(size), Machine(**machine.value)
        for batch in slices(batches):
            score = m.scores([terms.of(t) for t in byte_texts(batch.column("text"))])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(score, pa.float64()), "predicted": pa.array((score >= 0.5).astype(np.int32)),
            })

    kind = rows.schema["doc_id"].dataType.simpleString()
    keyed = rows.select("doc_id", (fold_remainder("doc_id", folds) == fold).alias("held_out"), "text")
    return keyed.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
