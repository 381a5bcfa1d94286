"""Suffix arrays, common prefixes and suffix-array dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
from edge_frames import edge_docs, edge_texts, ordered, words

from tillroll.llm import queries, suffix_array, suffix_dedup
from tillroll.llm.suffix_array import permuted_prefixes, sorted_by_pairs
from tillroll.llm.suffix_array import suffix_array as sorted_suffixes


def random_bytes(rng, n, letters):
    text = bytes(rng.randrange(letters) for _ in range(n))
    return (text[: rng.randrange(1, 6)] * n)[:n] if text and rng.random() < 0.3 else text


# 4096: the names of substrings are induced, too; 1: they are sorted by pairs.
@pytest.mark.parametrize("most_letters", [4096, 1])
def test_suffix_array_and_prefixes(monkeypatch, most_letters):
    monkeypatch.setattr(suffix_array, "MOST_LETTERS", most_letters)
    rng = random.Random(most_letters)
    for _ in range(400):
        text = random_bytes(rng, rng.randrange(0, 70), rng.choice([1, 2, 3, 5, 256]))
        t = np.frombuffer(text, np.uint8)
        order = sorted_suffixes(t)
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == expected
        if not text:
            continue
        cuts = sorted({0, *(rng.randrange(len(text)) for _ in range(3))})
        got = permuted_prefixes(t, order, np.array(cuts), np.diff([*cuts, len(text)]), 12)
        common = {expected[0]: 0}
        for a, b in zip(expected, expected[1:], strict=False):
            n = 0
            while n < 12 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            common[b] = n
        assert got.tolist() == [common[i] for i in range(len(text))]


def test_pairs_of_names():
    rng = random.Random(4)
    names = [rng.randrange(3) for _ in range(300)]
    assert sorted_by_pairs(np.array(names)).tolist() == sorted(range(300), key=lambda i: names[i:])


# Dedup


def expected_rows(rows, length=100):
    """By definition: rows with the same id and text are one document; rows with the same
    id are ordered by the hash of their text, which these rows do not need."""
    docs = sorted({(i, (t or "").encode()) for i, t, *_ in rows if i is not None})
    first = {}
    for i, text in docs:
        for at in range(len(text) - length + 1):
            first.setdefault(text[at : at + length], (i, text, at))
    results = {}
    for i, text in docs:
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - length + 1):
            if first[text[at : at + length]] != (i, text, at):
                gone[at : at + length] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        results[i, text] = (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    out = []
    for i, t, *_ in rows:
        text = (t or "").encode()
        out.append((i, *(results[i, text] if i is not None else (len(text), 0, 0, hashlib.sha256(text).hexdigest()))))
    return out


def rows_with_repeats():
    """Passages that many rows share between texts of their own, texts of one letter and
    of one line, and near copies."""
    rng = random.Random(8)
    passage, line = words(21, 40), "-" * 130
    base = words(22, 150).split()
    rows = []
    for i in range(60):
        own = words(100 + i, rng.randrange(1, 40))
        kind = i % 6
        if kind == 0:
            text = own + " " + passage + " " + words(200 + i, 5)
        elif kind == 1:
            text = own + line + own[:50] + line
        elif kind == 2:
            near = list(base)
            near[rng.randrange(150)] = f"x{i}"
            text = " ".join(near)
        elif kind == 3:
            text = "a" * rng.randrange(90, 400)
        elif kind == 4:
            text = (own + "é") * 3
        else:
            text = passage[: rng.randrange(80, 250)]
        rows.append((300 + (i * 7) % 60, text, "en", "s"))
    return rows


def written_query(spark, scratch, rows):
    edge_docs(spark, rows).repartition(5).write.parquet(f"{scratch}/documents.parquet")
    return queries.op11_suffix_dedup(spark, scratch)


def without_ambiguous_ids(rows):
    """Of rows with the same id and other texts only the last: the order among them follows
    a hash that this test does not repeat."""
    last = {i: t for i, t, *_ in rows}
    return [r for r in rows if r[0] is None or last[r[0]] == r[1]]


def test_suffix_dedup_edges(spark, scratch):
    rows = without_ambiguous_ids(edge_texts()) + rows_with_repeats()
    got = written_query(spark, scratch, rows)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert ordered([tuple(r) for r in got.collect()]) == ordered(expected_rows(rows))


def test_small_shards_wide_anchors_and_often_ones(spark, scratch, monkeypatch):
    """The paths of very frequent anchors give what the usual one gives."""
    monkeypatch.setattr(suffix_dedup, "SHARD", 1000)
    monkeypatch.setattr(suffix_dedup, "WIDE", 3)
    monkeypatch.setattr(suffix_dedup, "BATCH", 2000)
    rows = rows_with_repeats()
    got = written_query(spark, scratch, rows)
    assert ordered([tuple(r) for r in got.collect()]) == ordered(expected_rows(rows))


def test_outputs(spark):
    text = words(5, 60)
    docs = edge_docs(spark, [(1, text, "en", "s"), (2, "new " + text + " end", "en", "s"), (3, None, "en", "s")])
    rows = {r["doc_id"]: r for r in suffix_dedup.suffix_dedup(docs).collect()}
    assert bytes(rows[2]["kept"]) == b"new  end" and [tuple(s) for s in rows[2]["spans"]] == [(4, len(text))]
    assert bytes(rows[1]["kept"]).decode() == text and rows[1]["spans"] == []
    assert rows[3]["n_bytes"] == 0
    assert suffix_dedup.suffix_dedup(edge_docs(spark, [])).count() == 0


def test_rows_of_the_same_id_and_text_are_one_document(spark):
    text = words(6, 50)
    docs = edge_docs(spark, [(1, text, "en", "s")] * 5 + [(2, text, "en", "s")] * 3)
    got = ordered((r["doc_id"], r["n_removed"]) for r in suffix_dedup.suffix_dedup(docs).collect())
    assert got == [(1, 0)] * 5 + [(2, len(text))] * 3


def test_fragments_hold_every_window_once():
    rng = random.Random(2)
    texts = [random_bytes(rng, rng.randrange(0, 400), rng.choice([2, 30])) for _ in range(40)]
    found = suffix_dedup.text_fragments(texts, 100, 20)
    held = sorted((r, s + j) for r, s, n in zip(found["row"], found["start"], found["n"], strict=True) for j in range(n))
    assert held == [(r, at) for r, t in enumerate(texts) for at in range(len(t) - 99)]
    assert found["n"].max() <= 81
    # Equal windows have equal anchors at equal places of their fragments' texts.
    anchor_of = {}
    for a, r, s, n in zip(found["anchor"], found["row"], found["start"], found["n"], strict=True):
        for j in range(s, s + n):
            assert anchor_of.setdefault(texts[r][j : j + 100], a) == a
