"""The analyser (T-1..T-4) and term counts (T-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsync.functions.text import analyze
from reelsync.operators.terms import term_df, text_terms


def test_analyze(spark):
    df = spark.createDataFrame([(1, "The Cat's toys AND 'quoted' words, и в доме; don't 42")],
                               "id long, text string")
    got = df.select(analyze(F.col("text")).alias("t")).collect()[0]["t"]
    assert got == ["cat", "toys", "quoted", "words", "доме", "don't", "42"]


def test_term_counts(spark):
    df = spark.createDataFrame([(1, "cat cat dog"), (2, "Dog bird")], "id long, text string")
    terms = text_terms(df, "id", "text")
    assert sorted(tuple(r) for r in terms.collect()) == [
        (1, "cat", 2), (1, "dog", 1), (2, "bird", 1), (2, "dog", 1)]
    assert sorted(tuple(r) for r in term_df(terms).collect()) == [
        ("bird", 1), ("cat", 1), ("dog", 2)]
