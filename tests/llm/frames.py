"""Inputs with every kind of odd row, and plain versions of what the operators compute."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, n_words int, _id int, fp int"


def words(n, seed=0, size=4000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(size)}" for _ in range(n))


LONG = words(30_000, 5)
SHARED = words(60, 6)
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Eins, zwei. Drei!\n"), (6, LONG), (7, f"{words(30, 1)}\n{SHARED} {words(25, 2)}"),
    (8, f"{words(10, 3)} {SHARED}"), (9, SHARED), (9, SHARED), (10, words(80, 4)), (11, words(80, 4)), (None, words(40, 8)), (None, None),
    (12, "a" * 5000), (13, "é ß 日本 \U0001f600 " * 30), (14, f"{SHARED} {SHARED}"), (15, "0 1 2 ... !!"), (16, "x\x1cy\x85z w " * 9),
]


def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names that operators use."""
    rows = [(i, t, None if i == 4 else "en", None, None, 1.0, "c", 3, 4, 5) for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")
