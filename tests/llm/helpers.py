"""Small corpora, and plain Python versions of what the operators compute."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in every column, empty, blank and very long texts, ties, repeated rows, odd characters.
EDGES = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
    (None, "a text without an id", "en", None, 20),
    (None, None, None, None, None),
    (5, "same same same", "fr", "b", 14),
    (5, "same same same", "fr", "b", 14),
    (6, "same same same", "fr", "b", 14),
    (7, "word " * 30_000, "en", "a", 150_000),
    (8, "x" * 200_000, "de", "b", 200_000),
    (9, "1 2 3 4.5.6.7 " * 4_000, None, "c", 1),
    (10, "😀 é\u00a0ñ \u2003 ok\x00 \\ % ' \" $1", "es", "c", 1),
    (-4, "one two three four five six seven", "en", "a", 30),
]


def edge_docs(spark, clash: str = "weight"):
    """The edge rows with one more column, of a name that an operator might use itself."""
    return spark.createDataFrame([(*r, "kept") for r in EDGES], DOCS + f", `{clash}` string")


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def prose(n: int, seed: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{int(draw.random() ** 2 * vocabulary)}" for _ in range(n))


def copy_with_edits(text: str, edits: int, seed: int) -> str:
    draw, parts = random.Random(seed), text.split(" ")
    for k in range(edits):
        parts[draw.randrange(len(parts))] = f"new{seed}x{k}"
    return " ".join(parts)
