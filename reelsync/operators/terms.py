"""T-5, re-aimed: what the index's analysed fields compute, as Spark jobs.

``text_terms`` gives ``(id, term, tf)`` for every term of every document's
whole text; ``term_df`` the number of documents containing each term. Tokens
are exploded to rows first so the per-token work (regex, stop-word set) runs
in whole-stage codegen rather than inside a lambda; both counts aggregate
map-side before their shuffle, which keeps very common terms cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import distinct_terms, is_term, normalise_token, tokens
from .sinks import read_current, upsert


def text_terms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    toks = df.select(F.col(id_col).alias(id_col), F.explode(tokens(F.col(text_col))).alias("tok"))
    terms = toks.select(id_col, normalise_token(F.col("tok")).alias("term")).where(is_term(F.col("term")))
    return terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_df(terms: DataFrame) -> DataFrame:
    """Document frequency per term from ``text_terms`` output (one row per
    document and term, so a count is the number of documents)."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def document_frequency(df: DataFrame, text_col: str) -> DataFrame:
    """Document frequency per term straight from the texts, a row a document: a
    text's terms are made distinct where it is read, so that no pair of document
    and term is shuffled, only each task's count per term."""
    terms = df.select(F.explode(distinct_terms(F.col(text_col))).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def store_term_df(df: DataFrame, path: str, text_col: str) -> int:
    """Write the document frequencies of all texts as a stored table."""
    return upsert(document_frequency(df, text_col), path, ["term"], assume_unique=True)


def change_term_df(old: DataFrame, new: DataFrame, path: str, text_col: str) -> int:
    """Bring the stored frequencies up to date: ``old`` are the former texts of
    the documents that changed or went, ``new`` their texts now with those of
    new documents. Other texts are not read.

    Each document counts minus one for the terms it had and plus one for those
    it has; terms whose count moved are added to the stored counts by key. A
    term that no document has any more stays with a count of zero, which
    ``read_term_df`` leaves out.
    """
    signed = [texts.select(F.explode(distinct_terms(F.col(text_col))).alias("term"), F.lit(by).cast("long").alias("by"))
              for texts, by in ((old, -1), (new, 1))]
    moved = signed[0].unionByName(signed[1]).groupBy("term").agg(F.sum("by").alias("by")).where("by <> 0")
    stored = read_current(old.sparkSession, path)
    now = moved.join(stored, "term", "left").select("term", (F.coalesce("df", F.lit(0)) + F.col("by")).alias("df"))
    return upsert(now, path, ["term"], assume_unique=True)


def read_term_df(spark: SparkSession, path: str) -> DataFrame:
    return read_current(spark, path).where("df <> 0")
