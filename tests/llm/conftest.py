from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Word after word " * 6_000

#: Nulls in every column, empty and very long texts, ties, and repeated rows.
EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a", 44),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (None, "No id here, but some words.", "en", "b", 27),
    (None, None, None, None, None),
    (4, LONG, "en", "b", len(LONG)),
    (5, "  \t\n ", "de", "c", 5),
    (6, "12345 67890 !!!", "fr", "c", 15),
    (7, "Straße, Élan, naïve, ΣΑΣ, 漢字, 😀, ½, İ", "de", "c", 40),
    (8, "<|endoftext|> and <|startoftext|> are marks", "en", "", 43),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
