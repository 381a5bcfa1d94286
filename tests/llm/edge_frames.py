"""Small frames with the awkward rows that every operator must take."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, keep_id string, "
    "digest string, size int, shard string, block string, fp string, root string, tokens string, domain string, "
    "key string, label string, anchors string, n int, copies string, __id string, __tokens string, __row int, "
    "__domain string, __fp string, __copies string, row string"
)
EXTRAS = (
    0.5, "k", "d", 3, "s", "b", "f", "r", "t", "dom", "key", "lab", "a", 1, "c", "id", "tok", 7, "d2", "f2", "c2", "r2",
)


def words(seed: int, n: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_texts() -> list[tuple]:
    """(doc_id, text, lang, source)."""
    passage = words(1, 60)
    long = words(2, 20_000)
    base = words(3, 200)
    near = base.split()
    near[100] = "other"
    return [
        (1, "", "en", "src1"),
        (2, None, None, None),
        (3, "   \t\n ", "en", "src1"),
        (4, "One", "en", "src2"),
        (5, "one", "fr", "src2"),
        (6, "one two", "en", ""),
        (7, base, "en", "src1"),
        (8, base, "en", "src1"),
        (8, base, "en", "src1"),
        (8, words(9, 40), "en", "src3"),
        (9, " ".join(near), "en", "src1"),
        (10, words(4, 30) + " " + passage + " " + words(5, 30), "de", "src5"),
        (11, words(6, 25) + "\n" + passage + "\t" + words(7, 15), "de", "src5"),
        (12, long, "en", "src1"),
        (13, long[:50_000] + " " + words(8, 100), "en", "src1"),
        (14, "the the the " * 50, "en", "src1"),
        (15, "the the the " * 80, "en", "src1"),
        (16, "été ÉTÉ straße   x y \x1c z <|endoftext|> don't 12345 \U0001f600\U0001f600  !!! ", "fr", "src7"),
        (None, base, "en", "src1"),
        (None, None, "en", "src1"),
        (None, words(10, 50), None, "src9"),
        (17, "1234 5678 !!", "en", "src0"),
        (18, passage, "en", "src0"),
        (-5, passage + " " + words(11, 10), "en", "src0"),
    ] + [(100 + i, "Same copy of a text that many rows share, all of it.", "en", "hot") for i in range(40)]


def edge_docs(spark, rows: list[tuple] | None = None):
    rows = edge_texts() if rows is None else rows
    made = [(i, t, lang, source, None if t is None else len(t), *EXTRAS) for i, t, lang, source in rows]
    return spark.createDataFrame(made, SCHEMA)


def tuples(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))
