"""Language ID by a byte convolutional network.

Filters of several widths run over the bytes of a window; each filter's highest
activation over the window feeds a softmax over languages. A filter of width k is k
tables of 256 rows, one for each place, so a convolution is k table look-ups a byte.

The network is trained in numpy on one window of each of at most ``max_rows`` labelled
texts (those with the least hash of their id), also cut to random short lengths. A text
is cut into fixed-length windows that overlap by the widest filter less one byte, so
that all of it is read; windows go through the network in batches and their
probabilities are averaged by the number of bytes they hold.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is
every text if nothing could be learned; a null id is never in training nor held out; rows
with the same id stay rows of their own; ties go to the first language in the alphabet;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_texts, fold_remainder, least_hashed, slices

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
STEP = WINDOW - max(WIDTHS) + 1


@dataclass
class Network:
    langs: list[str]
    #: tables[k]: a row for each byte at place k of a filter, for the filters that are
    #: wider than k; filters are in the order of their width.
    tables: list[np.ndarray]
    bias: np.ndarray  # of the softmax
    out: np.ndarray  # (filters, languages)

    def activations(self, x: np.ndarray) -> np.ndarray:
        """Every filter at every place of each window (rows of byte values)."""
        n = x.shape[1] - len(self.tables) + 1
        z = np.take(self.tables[0], x[:, :n], axis=0, mode="clip")
        for k, table in enumerate(self.tables[1:], 1):
            z[:, :, z.shape[2] - table.shape[1] :] += np.take(table, x[:, k : k + n], axis=0, mode="clip")
        return z

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        top = np.concatenate([self.activations(x[at : at + 8]).max(axis=1) for at in range(0, len(x), 8)])
        return softmax(np.maximum(top, 0) @ self.out + self.bias)


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def windows_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The windows of a text as rows of byte values, zero beyond its end, and how many
    bytes of the text each is the first to hold. Filters begin at STEP places of a window."""
    n = max(1, -(-len(text) // STEP))
    padded = np.zeros(n * STEP + WINDOW - STEP, np.intp)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]
    return rows, np.maximum(np.minimum(STEP, len(text) - np.arange(n) * STEP), 1)


def fit(
    texts: list[bytes], labels: list[str], filters: int = 16, epochs: int = 12, rate: float = 0.01, seed: int = 5
) -> Network:
    """Adam on the cross-entropy; classes weigh alike, and half of the windows are cut to
    a random short length each time. A text that is longer than a window, as one of
    letters of several bytes may be, is learned window by window; short rests are left out."""
    rng = np.random.default_rng(seed)
    parts = [
        (t[i : i + WINDOW], lang)
        for t, lang in zip(texts, labels, strict=True)
        for i in range(0, max(len(t), 1), WINDOW)
        if i == 0 or len(t) - i >= 32
    ]
    texts, labels = [t for t, _ in parts], [lang for _, lang in parts]
    langs = sorted(set(labels))
    y = np.searchsorted(langs, labels)
    x = np.stack([windows_of(t[:WINDOW])[0][0] for t in texts])
    length = np.array([min(len(t), WINDOW) for t in texts])
    every = filters * len(WIDTHS)
    net = Network(
        langs,
        [rng.normal(0, 0.1, (256, filters * sum(w > k for w in WIDTHS))).astype(np.float32) for k in range(max(WIDTHS))],
        np.zeros(len(langs), np.float32), rng.normal(0, 0.1, (every, len(langs))).astype(np.float32),
    )
    weigh = (len(y) / len(langs) / np.bincount(y, minlength=len(langs)))[y]
    params = [*net.tables, net.bias, net.out]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            cut = np.where(rng.random(len(some)) < 0.5, rng.integers(8, WINDOW, len(some)), length[some])
            block = np.where(np.arange(WINDOW) < cut[:, None], x[some], 0)
            z = net.activations(block)
            where = z.argmax(axis=1)
            top = np.maximum(np.take_along_axis(z, where[:, None], axis=1)[:, 0], 0)
            p = softmax(top @ net.out + net.bias)
            p[np.arange(len(some)), y[some]] -= 1
            p *= (weigh[some] / len(some))[:, None]
            back = (p @ net.out.T) * (top > 0)
            grads = []
            for k, table in enumerate(net.tables):
                g, own = np.zeros_like(table), slice(every - table.shape[1], every)
                symbol = np.take_along_axis(block, where[:, own] + k, axis=1)
                np.add.at(g, (symbol, np.arange(table.shape[1])[None, :]), back[:, own])
                grads.append(g)
            grads += [p.sum(axis=0), top.T @ p]
            step += 1
            for q, g, a, b in zip(params, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                q -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def train(rows: DataFrame, max_rows: int, **how) -> Network | None:
    """rows: (doc_id, text, lang); one stretch of each of at most ``max_rows`` texts."""
    usable = rows.where("doc_id is not null and lang is not null and text is not null and length(text) > 0")
    size = F.length("text")
    begin = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(size - WINDOW, F.lit(1))) + 1
    cut = usable.select(F.xxhash64("doc_id").alias("h"), "doc_id", "lang", F.col("text").substr(begin.cast("int"), F.lit(WINDOW)).alias("text"))
    ties = ("doc_id", "lang", "text")
    n = rows.where("doc_id is not null and lang is not null").count()
    got = least_hashed(cut, n, max_rows, *ties).select("lang", "text").toArrow()
    if got.num_rows < max_rows:  # many repeated ids or empty texts
        got = cut.orderBy("h", *ties).limit(max_rows).select("lang", "text").toArrow()
    if not got.num_rows:
        return None
    return fit(byte_texts(got.column("text")), got.column("lang").to_pylist(), **how)


def predicted(rows: DataFrame, net: Network | None, passed: list[str]) -> DataFrame:
    """lang_pred and score of every row's ``text``, with the ``passed`` columns."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(net) if net else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(**shared.value) if shared.value else None
        ascii_letter = re.compile(rb"[A-Za-z]")
        for batch in slices(batches):
            lang, score = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)

            def settle(block: list, lang=lang, score=score) -> None:
                p = model.probabilities(np.concatenate([w for _, w, _ in block]))
                total = np.add.reduceat(
                    p * np.concatenate([h for _, _, h in block])[:, None],
                    np.cumsum([0] + [len(h) for _, _, h in block])[:-1],
                )
                for (k, _, _), t in zip(block, total, strict=True):
                    if k in part:
                        t = part.pop(k) + t
                    part[k] = t

            part: dict[int, np.ndarray] = {}
            block, size = [], 0
            for k, text in enumerate(byte_texts(batch.column("text"))):
                if model is None or not (ascii_letter.search(text) or any(map(str.isalpha, text.decode("utf-8", "replace")))):
                    continue
                rows, held = windows_of(text)
                for at in range(0, len(rows), 128):
                    block.append((k, rows[at : at + 128], held[at : at + 128]))
                    size += len(block[-1][1])
                    if size >= 128:
                        settle(block)
                        block, size = [], 0
            if block:
                settle(block)
            for k, t in part.items():
                t = t / t.sum()
                lang[k], score[k] = model.langs[int(t.argmax())], float(t.max())
            yield pa.record_batch({
                **{c: batch.column(c) for c in passed},
                "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64()),
            })

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in passed)
    return rows.mapInArrow(run, kinds + "lang_pred string, score double")


def language_ids(
    docs: DataFrame, folds: int = 4, fold: int = 2, max_rows: int = 6_000,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score; learned from those
    whose id's crc32 modulo ``folds`` is not ``fold``."""
    net = train(_training_rows(docs, folds, fold, id_col, text_col, lang_col), max_rows, **how)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (fold_remainder(id_col, folds) == fold).alias("held_out"), F.col(text_col).alias("text")
    )
    return predicted(rows, net, ["doc_id", "held_out"])


def _training_rows(docs, folds, fold, id_col, text_col, lang_col):
    return docs.where(fold_remainder(id_col, folds) != fold).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )


def language_filter(
    docs: DataFrame, min_score: float = 0.0, accepted: list[str] | None = None, folds: int = 4, fold: int = 2,
    max_rows: int = 6_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how,
) -> DataFrame:
    """The rows of ``docs`` whose language could be told (with at least ``min_score``) and is
    among ``accepted``, by default every learned one."""
    net = train(_training_rows(docs, folds, fold, id_col, text_col, lang_col), max_rows, **how)
    # The text goes to the network under a name of its own beside all columns.
    names = [f"__c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)), F.col(text_col).alias("text"))
    found = predicted(rows, net, names)
    kept = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)
    if accepted is not None:
        kept &= F.col("lang_pred").isin(accepted)
    return found.where(kept).select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))
