"""Toxicity, language-model scores, token counts and language ID."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from edge_frames import edge_docs, edge_texts, ordered, tuples, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import lm_score, toxicity
from tillroll.llm.common import PIECE, word_hashes
from tillroll.llm.language_id import UNDETERMINED, WINDOW, language_filter, language_ids, windows_of
from tillroll.llm.lm_score import LogFrequencyFilter, lm_scores, tokens_of
from tillroll.llm.queries import op1_toxicity, op3_lm_score, op5_language_id, tokenizer_path
from tillroll.llm.token_counts import PreTokens, token_counts
from tillroll.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


# Words


def test_word_hashes_follow_the_words():
    rng = random.Random(4)
    alphabet = "ab\u00e9\x1c\x85 \t\n\x0b\x0c\r"
    seen = {}
    for size in [0, 1, 5, 40] * 100 + [PIECE * 2 + 77]:
        text = "".join(rng.choices(alphabet, k=size)).encode()
        if size > PIECE:
            text = b"x" * 70 + b" " + text + b"y" * (PIECE + 9) + b" z " + b"w" * (2 * PIECE)
        split, hashed = text.split(), word_hashes(text).tolist()
        assert len(split) == len(hashed)
        for word, h in zip(split, hashed, strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


# Toxicity


def test_machine_learns_what_no_linear_model_can():
    rng = random.Random(1)
    texts, labels = [], []
    for _ in range(2000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(({1} if a else set()) | ({2} if b else set()) | {rng.randrange(3, 40) for _ in range(5)})
        labels.append(float(a == b))
    m = toxicity.fit(texts, np.array(labels), min_z=0.0, epochs=60)
    right = ((m.scores(texts) >= 0.5) == np.array(labels)).mean()
    assert right > 0.97
    assert np.abs(m.w).max() < np.abs(m.v @ m.v.T).max()


def test_default_terms_include_those_that_tell_in_pairs_only():
    rng = random.Random(1)
    texts, labels = [], []
    for _ in range(2000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(({1} if a else set()) | ({2} if b else set()) | {rng.randrange(3, 40) for _ in range(5)})
        labels.append(float(a == b))
    m = toxicity.fit(texts, np.array(labels), epochs=60)
    assert {1, 2} <= set(m.places.tolist())
    assert ((m.scores(texts) >= 0.5) == np.array(labels)).mean() > 0.97


def test_a_pair_with_a_rare_term_is_learned_with_the_defaults():
    """The label follows term 1 in the few texts that have term 2, and chance elsewhere."""
    rng = np.random.default_rng(3)
    n = 12_000
    texts, labels = [], []
    for i in range(n):
        own = set((rng.integers(100, 5000, 20)).tolist())
        one, two = rng.random() < 0.5, i % 100 == 0
        texts.append(own | ({1} if one else set()) | ({2} if two else set()))
        labels.append(float(one) if two else float(rng.random() < 0.5))
    m = toxicity.fit(texts, np.array(labels))
    assert {1, 2} <= set(m.places.tolist())
    rare = [i for i in range(n) if i % 100 == 0]
    got = m.scores([texts[i] for i in rare])
    assert np.mean((got >= 0.5) == (np.array(labels)[rare] > 0.5)) > 0.9


def test_scores_equal_the_double_sum():
    rng = np.random.default_rng(4)
    m = toxicity.Machine(np.array([2, 5, 9, 11]), -0.3, rng.normal(size=4), rng.normal(size=(4, 3)))
    texts = [set(), {2}, {2, 5, 7}, {1, 2, 5, 9, 11}]
    for text, got in zip(texts, m.scores(texts), strict=True):
        rows = [i for i, p in enumerate(m.places) if p in text]
        margin = m.w0 + sum(m.w[i] for i in rows)
        margin += sum(m.v[i] @ m.v[j] for a, i in enumerate(rows) for j in rows[a + 1 :])
        assert abs(got - 1 / (1 + np.exp(-margin))) < 1e-12


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    labels = [(i, t) for i, t, *_ in edge_texts()]
    frame = spark.createDataFrame(
        [(i, None if i == 4 else int(i is not None and i > 100), "x") for i, _ in labels] + [(None, 1, "x"), (101, 0, "x")],
        "doc_id bigint, toxic int, text string",
    )
    got = tuples(toxicity_scores(docs, frame), "doc_id", "held_out", "score", "predicted")
    assert len(got) == len(labels)
    for i, held_out, score, predicted in got:
        assert 0 <= score <= 1 and predicted == int(score >= 0.5)
        assert held_out == (fold(i, 5) == 0)
    assert toxicity_scores(edge_docs(spark, []), frame).count() == 0
    none = tuples(toxicity_scores(docs, frame.limit(0)), "predicted")
    assert set(none) == {(0,)}


def test_toxicity_held_out(spark):
    rows = op1_toxicity(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    both = rows.merge(labels, on="doc_id")
    held = both[both.held_out]
    # Some labels are wrong on purpose; most of the toxic rows hold an insult.
    assert (held.predicted == held.toxic).mean() > 0.88
    assert held[held.toxic == 0].score.mean() < 0.25 < held[held.toxic == 1].score.mean()


# Language model


def test_filter_reads_counts_back():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    levels = rng.integers(0, 9, 5000)
    held = LogFrequencyFilter.built(keys, levels, 1 << 20, 6)
    assert (held.levels(keys) >= levels).all() and (held.levels(keys) == levels).mean() > 0.99
    others = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert (held.levels(others) >= 0).mean() < 3 * held.expected_error(int((levels + 1).sum())) + 0.002


def test_probabilities_add_up(spark):
    texts = [(words(i, 60, 25),) for i in range(30)]
    model, counts = lm_score.train(spark.createDataFrame(texts, "text string"), share=40, context_share=20)
    types = [r["key"] for r in counts.collect()]
    assert model.types == len(types) == 26 and model.tokens == 30 * 61
    unseen = b"unseen"
    for before in (types[0], types[5], unseen):
        total = 0.0
        for word in [*types, unseen]:
            total += 10 ** model.log10(lm_score.key_hashes([bytes(before), bytes(word)]), np.array([0]))[1]
        assert total == pytest.approx(1.0, abs=1e-6)


def test_model_holds_every_word_and_pair(spark, monkeypatch):
    # Rare pairs of rare words among very many tokens, in several blocks and chunks.
    monkeypatch.setattr(lm_score, "PAIRS_IN_BLOCK", 1 << 17)
    monkeypatch.setattr(lm_score, "WORDS_IN_BLOCK", 1 << 8)
    texts = [("the " * 30_000,)] * 40 + [(words(i, 60, 900),) for i in range(30)]
    model, counts = lm_score.train(spark.createDataFrame(texts, "text string").repartition(5))
    assert model.tokens > 1 << 20 and model.word_blocks > 2 and model.pair_blocks > 5
    c, pairs = Counter(), Counter()
    for (t,) in texts:
        ws = tokens_of(t.encode())
        c.update(ws)
        pairs.update(zip(ws, ws[1:], strict=False))
    keys = sorted(pairs)
    low = lambda n: 2.0 ** math.floor(math.log2(n))
    mass = Counter()
    for (u, w), n in pairs.items():
        mass[u] += low(n) / (2 * low(c[u]))
    total = sum(low(n) for n in c.values()) * math.sqrt(2) + 1
    flat = [w for p in keys for w in p]
    got = 10 ** model.log10(lm_score.key_hashes(flat), np.arange(0, len(flat), 2))[1::2]
    want = [
        0.3 * low(pairs[u, w]) / (2 * low(c[u])) + (1 - 0.3 * mass[u]) * low(c[w]) * math.sqrt(2) / total for u, w in keys
    ]
    # A filter may read a count too high, never too low.
    assert np.mean(np.isclose(got, want, rtol=1e-6)) > 0.98
    assert all(g > 0.9 * w for g, w in zip(got, want, strict=True))


def test_long_words_are_in_the_model(spark):
    long = "=" * 65 + " " + "x" * 40_000
    model, _ = lm_score.train(spark.createDataFrame([(long + " a",)] * 30, "text string"))
    seen = model.log10(lm_score.token_hashes(long.encode()), np.array([0]))
    unseen = model.log10(lm_score.token_hashes(b"unseen"), np.array([0]))
    assert (seen[:2] > unseen[0] + 1).all()
    # The pair is held, too: 2^4 of the next power of two, 2^5.
    assert 10 ** seen[1] == pytest.approx(0.3 * 0.5 + (1 - 0.3 * 0.5) * 10 ** seen[0], rel=1e-6)


def test_chunks_score_as_the_model_does(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CHUNK", 500)
    rows = [(i, words(i, 1 + 7 * i % 90, 40), "en", "s") for i in range(60)]
    d = edge_docs(spark, rows).selectExpr("monotonically_increasing_id() as __row", "doc_id", "false as held_out", "text")
    model, _ = lm_score.train(d.where("doc_id % 3 > 0").select("text"))
    got = dict(tuples(lm_score.score(d, model), "doc_id", "score"))
    assert len(got) == 60
    for i, t, *_ in rows:
        assert got[i] == pytest.approx(model.log10(lm_score.token_hashes(t.encode()), np.array([0])).sum())


def test_lm_base_is_exact_at_the_edges(spark, monkeypatch):
    rows = edge_texts()
    trained = [(i, tokens_of((t or "").encode())) for i, t, *_ in rows if i is not None and fold(i, 7) != 2]
    c = Counter(w for _, ws in trained for w in ws)
    n, v = sum(c.values()), len(c)
    want = []
    for i, t, *_ in rows:
        ws = tokens_of((t or "").encode())
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        want.append((i, fold(i, 7) == 2, len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6)))
    for chunk, blocks in ((lm_score.CHUNK, lm_score.PAIRS_IN_BLOCK), (64, 256)):
        monkeypatch.setattr(lm_score, "CHUNK", chunk)
        monkeypatch.setattr(lm_score, "PAIRS_IN_BLOCK", blocks)
        frame = lm_score.lm_scores(edge_docs(spark))
        if chunk == 64:
            d = edge_docs(spark).selectExpr("monotonically_increasing_id() as __row", "doc_id", "crc32(cast(cast(doc_id as string) as binary)) % 7 <=> 2 as held_out", "text")
            model, _ = lm_score.train(d.where("doc_id is not null and not held_out").select("text"))
            frame = lm_score.score(d, model)
        got = [(r[0], bool(r[1]), r[2], r[3], r[4], round(r[5], 6)) for r in tuples(frame, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")]
        assert ordered(got) == ordered(want)
        assert all(r["score"] <= 0 for r in frame.collect())
    assert lm_scores(edge_docs(spark, [])).count() == 0
    alone = lm_scores(edge_docs(spark, [(None, "a b", "en", "s")])).first()
    assert alone["train_tokens"] == 0 and alone["n_known"] == 0 and alone["n_tokens"] == 3


def test_lm_beats_the_base_on_held_out_text(spark):
    rows = op3_lm_score(spark, SF).toPandas()
    held = rows[rows.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert (held.score > held.base_score).mean() > 0.8


# Token counts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def pre_tokens(library):
    return PreTokens(library.to_str())


def test_token_counts_edges(spark, library):
    rows = edge_texts()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows]
    for head in (1 << 21, 1 << 5):
        got = token_counts(edge_docs(spark), tokenizer_path(), head_share=head)
        assert ordered(tuples(got, "doc_id", "n_bytes", "n_tokens")) == ordered(want)
        assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got.collect())
    assert token_counts(edge_docs(spark, []), tokenizer_path()).count() == 0


SPACES = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0 ᠎   ​    ⁠　﻿"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*SPACES, " word", " word,", " ***", "\n", "a", "'s", "'", "9", "!", "é", "<|endoftext|>", "<|", "\U0001f600"]), st.text(max_size=4)), max_size=30))
def test_pieces_of_pre_tokens_add_up(library, pre_tokens, parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    cut = pre_tokens
    special, chunks = cut.texts(text)
    pieces = [p for c in chunks for p in cut.of_chunk(c)]
    assert special + sum(cut.pieces(pieces)) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_a_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = dict(tuples(token_counts(docs, tokenizer_path()), "doc_id", "n_tokens"))
    rows = tuples(docs, "doc_id", "text")
    want = library.encode_batch([t for _, t in rows], add_special_tokens=False)
    assert got == {i: len(e.ids) for (i, _), e in zip(rows, want, strict=True)}


# Language ID


def test_windows_hold_every_run_of_bytes_once():
    for n in (0, 1, 255, 256, 257, 508, 509, 510, 5000):
        text = bytes(i % 251 + 1 for i in range(n))
        rows, held = windows_of(text)
        assert rows.shape[1] == WINDOW and held.sum() == max(n, 1)
        for at in range(0, max(0, n - 3)):
            assert any(text[at : at + 4] in bytes(r.tolist()) for r in rows[max(0, at // 253 - 1) : at // 253 + 1])


def test_language_edges(spark):
    got = tuples(language_ids(edge_docs(spark), epochs=2), "doc_id", "held_out", "lang_pred", "score")
    rows = edge_texts()
    assert len(got) == len(rows)
    blank = [i for i, t, *_ in rows if not any(map(str.isalpha, t or ""))]
    assert ordered([(i,) for i, _, lang, _ in got if lang == UNDETERMINED]) == ordered([(i,) for i in blank])
    assert all(0 <= s <= 1 and h == (fold(i, 4) == 2) for i, h, _, s in got)
    assert {lang for _, _, lang, _ in got} <= {"en", "fr", "de", UNDETERMINED}
    assert language_ids(edge_docs(spark, [])).count() == 0
    nothing = tuples(language_ids(edge_docs(spark, [(1, "abc", None, "s")])), "lang_pred", "score")
    assert nothing == [(UNDETERMINED, 0.0)]


def test_language_filter_keeps_rows_as_they_are(spark):
    docs = edge_docs(spark)
    kept = language_filter(docs, epochs=2)
    assert kept.schema.names == docs.schema.names
    want = [r for r in docs.collect() if any(map(str.isalpha, r["text"] or ""))]
    assert Counter(map(str, kept.collect())) == Counter(map(str, want))


def test_language_held_out_accuracy(spark):
    rows = op5_language_id(spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/documents.parquet").toPandas(), on="doc_id")
    held = rows[rows.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
