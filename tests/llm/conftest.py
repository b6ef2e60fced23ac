"""Rows with every kind of dirt the corpus operators must bear, and helpers to build small tables."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def make(spark):
    def build(rows, schema=DOCS):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def dirty_docs():
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, rows that share an id."""
    passage = " ".join(f"pass{i}" for i in range(120))
    rows = [
        (1, f"intro one {passage} tail", "en", "a", 5),
        (2, f"other start {passage} end", "en", "b", 5),
        (2, f"other start {passage} end", "en", "b", 5),
        (3, "", "en", "a", 0),
        (4, None, None, None, None),
        (None, f"no id {passage}", "en", None, 1),
        (None, None, None, "c", None),
        (5, " \t\n ", "de", "c", 4),
        (6, LONG, "en", "c", len(LONG)),
        (7, LONG[:50_000] + " é ü 漢字 😀 " + LONG[50_000:], "en", "", 1),
        (8, "é" * 150 + "a" * 400, "fr", "a", 1),
        (9, "one two", "en", "b", 7),
        (9, "one two three", "en", "b", 7),
    ]
    return rows


def same_rows(got, expected):
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)
