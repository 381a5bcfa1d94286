"""Periodic runs and ranked lexical search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from edge_frames import edge_docs, edge_texts, ordered, tuples, words

from tillroll.llm import queries
from tillroll.llm.lexical_search import Block, lexical_search, terms_of
from tillroll.llm.periodic_runs import find_runs, period_classes, periodic_runs

# Periodic runs


def brute_runs(w, min_length=6, min_exponent=4):
    """Every maximal stretch of every lag whose smallest period the lag is."""
    found, n = [], len(w)
    for q in range(1, n):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, min_exponent * q):
                stretch = w[i : i + length]
                if not any(all(x == y for x, y in zip(stretch, stretch[p:])) for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_text(rng):
    kind = rng.randrange(4)
    n = rng.randrange(0, 120)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        return [rng.randrange(50) for _ in range(n)]
    out = []
    while len(out) < n:
        unit = [rng.randrange(rng.choice([2, 3, 30])) for _ in range(rng.randrange(1, 12))]
        out += (unit * rng.randrange(1, 8))[: rng.randrange(1, 60)]
        if kind == 3 and out and rng.random() < 0.3:
            out[rng.randrange(len(out))] = 99
    return out


@pytest.mark.parametrize("min_length, min_exponent", [(6, 4), (1, 2), (9, 3), (20, 2)])
def test_runs_against_brute_force(min_length, min_exponent):
    rng = random.Random(min_length)
    for _ in range(60):
        texts = [random_text(rng) for _ in range(8)]
        w = np.array([x for t in texts for x in t], np.int64)
        bounds = np.cumsum([0] + [len(t) for t in texts])
        assert find_runs(w, bounds, min_length, min_exponent) == [brute_runs(t, min_length, min_exponent) for t in texts]


def test_long_periods_and_long_runs():
    rng = random.Random(5)
    unit = [rng.randrange(9) for _ in range(700)]
    w = [7, 8] + unit * 5 + [10, 11] + [3] * 5000
    found = find_runs(np.array(w), np.array([0, len(w)]))[0]
    assert {(2, 3500, 700), (3504, 5000, 1)} <= set(found)


def test_no_class_is_shorter_than_its_periods():
    classes = list(period_classes(10_000, 6, 4))
    assert classes[0] == (1, 5, 5) and classes[1] == (6, 18, 18)
    assert all(first <= last == k for first, last, k in classes)


def collapsed(words_, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(words_) if i not in gone)


def expected_op12(rows):
    out = []
    for i, text, *_ in rows:
        w = queries.repeated_tail(i, (text or "").encode().split())
        runs = brute_runs(w)
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2] or (
                r[1] * best[2] == best[1] * r[2] and (r[0], r[2]) < (best[0], best[2])
            ):
                best = r
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        out.append((
            i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs)).hexdigest(),
        ))
    return out


def short_edges():
    long = random.Random(3)
    extra = [(i, " ".join(str(x) for x in random_text(long)), "en", "s") for i in range(200, 300)]
    return [r if len(r[1] or "") < 3000 else (r[0], r[1][:3000], *r[2:]) for r in edge_texts()] + extra


def test_periodic_runs_query(spark, scratch):
    rows = short_edges()
    edge_docs(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    got = queries.op12_periodic_runs(spark, scratch)
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert [t for _, t in got.dtypes[:6]] == ["bigint"] * 6
    assert ordered([tuple(r) for r in got.collect()]) == ordered(expected_op12(rows))


def test_periodic_runs_outputs(spark):
    got = periodic_runs(edge_docs(spark, [(1, "x " + "a b " * 5 + "y", "en", "s"), (None, None, "en", "s")]))
    rows = {r["doc_id"]: r for r in got.collect()}
    assert [tuple(x) for x in rows[1]["runs"]] == [(1, 10, 2)]
    assert rows[1]["collapsed_text"] == "x a b y" and rows[1]["n_words"] == 12
    assert rows[None]["runs"] == [] and rows[None]["collapsed_text"] == ""
    assert periodic_runs(edge_docs(spark, [])).count() == 0


# Ranked lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    """Scores of all documents for every item; rows of docs are (id, text)."""
    held = [(i, Counter(brute_terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        if item is None:
            continue
        scored = []
        for (i, c), n in zip(held, sizes, strict=True):
            if not n:
                continue
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in brute_terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort(key=lambda x: x[:3])
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(scored[:k], 1)]
    return out


ITEMS = [
    (1, "Same copy of a TEXT"), (2, ""), (3, None), (4, "w1 w2 w3 w2 w2 w77"), (5, "unknownterm"),
    (6, words(1, 30)), (None, "one two"), (7, "été straße don't"), (7, "one"), (8, "the the"), (9, words(2, 200)),
]


@pytest.mark.parametrize("k", [1, 10, 100])
def test_search_edges(spark, k):
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id bigint, text string, doc_id string")
    got = tuples(lexical_search(edge_docs(spark), items, k=k), "item_id", "rank", "doc_id", "score")
    assert ordered(got) == ordered(brute_search([r[:2] for r in edge_texts()], ITEMS, k))


def test_search_empty(spark):
    items = spark.createDataFrame([(1, "one")], "item_id int, text string")
    assert lexical_search(edge_docs(spark, []), items).count() == 0
    assert lexical_search(edge_docs(spark), items.limit(0)).count() == 0
    assert lexical_search(edge_docs(spark, [(1, None, "en", "s")]), items).count() == 0


def test_search_in_blocks(spark, monkeypatch):
    """Several blocks of documents and of items give what one gives."""
    from tillroll.llm import lexical_search as module

    monkeypatch.setattr(module, "ITEM_WORDS", 20)
    monkeypatch.setattr(module, "BLOCK_DOCS", 8)
    items = spark.createDataFrame([r for r in ITEMS if r[0] is not None], "item_id bigint, text string")
    got = tuples(lexical_search(edge_docs(spark).repartition(5), items), "item_id", "rank", "doc_id", "score")
    assert ordered(got) == ordered(brute_search([r[:2] for r in edge_texts()], ITEMS, 10))


def random_block(rng, n_docs, n_lists):
    terms, docs, values = [], [], []
    for d in range(n_docs):
        for t in range(n_lists):
            if rng.random() < 0.5:
                terms.append(t), docs.append(d), values.append(int(rng.choice([1, 2, 3, 1000 * rng.random() ** 4])))
    order = np.lexsort((docs,))
    return (np.array(x, np.int64)[order] for x in (terms, docs, values))


def test_best_positions_stop_early_and_lose_nothing():
    rng = random.Random(1)
    met_of = []
    for trial in range(30):
        n_docs = 3000 if trial < 3 else 60
        terms, docs, values = random_block(rng, n_docs, 4)
        block = Block(np.arange(n_docs)[::-1].copy(), terms, docs, values, 4)
        times = [1, 2, 1, 3]
        for _ in range(2):  # the block is reused
            found, scores, met = block.search([0, 1, 2, 3], times, 10)
        whole = np.zeros(n_docs, np.int64)
        np.add.at(whole, docs, np.array(times)[terms] * values)
        order = sorted(range(n_docs), key=lambda d: (-whole[d], block.ids[d]))[:10]
        expected = [d for d in order if whole[d] > 0]
        assert found.tolist() == expected and scores.tolist() == whole[expected].tolist()
        met_of.append(met / n_docs)
    assert max(met_of[:3]) < 0.5


def test_terms():
    text = "Ab-c_1É\x00ß!zé 9\x7f　Q"
    assert [t.decode() for t in terms_of(text.encode())] == brute_terms(text)
