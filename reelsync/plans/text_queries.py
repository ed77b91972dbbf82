"""Queries over text analysis (T-1..T-5) on the whole of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS
from ..operators.terms import change_term_df, document_frequency, read_term_df, store_term_df, text_terms
from ..session import shared_path
from ..sources.tables import read_table
from .registry import register

_STOP_SQL = ", ".join("'" + w + "'" for w in STOP_WORDS)

TERMS_CTE = f"""WITH toks AS (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\pL\\pN'']+')) AS tok FROM documents),
terms AS (
  SELECT doc_id,
         regexp_replace(regexp_replace(regexp_replace(tok, '^''+', ''), '''+$', ''), '''s$', '')
           AS term
  FROM toks),
doc_terms AS (
  SELECT doc_id, term, count(*) AS tf FROM terms
  WHERE length(term) > 0 AND term NOT IN ({_STOP_SQL})
  GROUP BY doc_id, term)
"""


@register("text_terms", TERMS_CTE + "SELECT doc_id, term, tf FROM doc_terms")
def text_terms_q(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """T-1..T-5: term frequencies of every document's whole text."""
    return text_terms(read_table(spark, sf_dir, "documents", partitions), "doc_id", "text")


@register("term_df", TERMS_CTE + "SELECT term, count(*) AS df FROM doc_terms GROUP BY term")
def term_df_q(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """T-5: document frequency of every term."""
    return document_frequency(read_table(spark, sf_dir, "documents", partitions), "text")


@register("term_df_changes", TERMS_CTE + "SELECT term, count(*) AS df FROM doc_terms GROUP BY term")
def term_df_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-5: document frequencies kept up to date: stored while a tenth of the
    documents had another text (reversed), a twentieth was not there and some
    others still were, then brought to the present by those documents alone."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    number = F.col("doc_id") % 20
    edited = docs.where(number < 2)
    old = edited.withColumn("text", F.reverse("text"))
    gone = docs.where(number == 5).withColumn("doc_id", -F.col("doc_id") - 1)
    path = shared_path(spark, "term_df_changes", unique=True)
    store_term_df(docs.where(number > 2).unionByName(old).unionByName(gone), path, "text")
    change_term_df(old.unionByName(gone), docs.where(number <= 2), path, "text")
    return read_term_df(spark, path)
