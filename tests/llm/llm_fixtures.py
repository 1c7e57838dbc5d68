"""Fixtures the tests of this folder import, and a helper."""

from __future__ import annotations

import os

import pytest

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")

LONG = "Und der lange Text geht immer weiter, token = 'abcdef0123456789'. " * 2000
EDGES = [
    (1, "The quick brown fox jumps over the lazy dog", "en"),
    (1, "The quick brown fox jumps over the lazy dog", "en"),  # a repeated row
    (2, "THE QUICK  brown fox\njumps over the lazy dog", None),
    (3, None, "de"),
    (4, "", None),
    (5, " \t\n", "en"),
    (6, "one two", "en"),
    (7, "1234 !!! ---", None),
    (None, "El veloz zorro marrón salta sobre el perro perezoso", "es"),
    (None, None, None),
    (8, LONG, "de"),
    (9, LONG + " Ende", "de"),
]


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no sample tables")
    return FOLDER


@pytest.fixture
def edge_docs(spark):
    """Odd rows, with extra columns named like the operators' own."""
    rows = [(i, t, lang, 0.5, "x", 7, 8, "r") for i, t, lang in EDGES]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, score double, spans string, shard int, "
        "rank int, row string",
    )


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.limit(0)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: [(v is None, v) for v in r])
