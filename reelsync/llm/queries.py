"""Registered queries of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bpe, fingerprints, hard_negatives, html_text, langid, licenses, mixing, neighbours, quality,
               secrets, simhash, token_counts)
from .shared import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file (the same on every machine)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compared(fingerprints.edited_fingerprints(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.char_length("text").cast("long").alias("n_chars"),
                        F.sha2("edited", 256).alias("edited_sha256"),
                        fingerprints.text_form(F.col("fp")).alias("fingerprint"),
                        fingerprints.text_form(F.col("edited_fp")).alias("edited_fingerprint"),
                        "near_edited", "near_next")


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target",
                                   (F.col("size") * F.col("copies")).alias("taken"))


ORACLE_SQL["op2_mixing"] = mixing.MIX_SQL


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     tokenizer("byte_bpe_50k.json"), limit=1024)


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, drop=("text",), decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def fold(modulus: int) -> F.Column:
    """The remainder that decides a document's fold; a NULL id is in none."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, spans="s", drop=("text",), vocabulary=tokenizer("byte_bpe_50k.json"))
    base = F.filter("s", lambda x: x.kind != "guess")
    listed = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(
        ":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    count = lambda kind: F.size(F.filter("s", lambda x: x.kind == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("s")).alias("spans"))


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(5) == 0, F.lit(False))
    learn = docs.select("doc_id", "text", "lang").where(~held_out)
    found = langid.identify(docs.select("doc_id", "text"), learn, drop=("text",))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    learn = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    scored = quality.score(docs, quality.fit(docs, learn), drop=("text",))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


ORACLE_SQL["op11_hard_negatives"] = hard_negatives.MINE_SQL


@query
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.find_licenses(table(spark, sf_dir, "documents")), "doc_id")


ORACLE_SQL["op12_licenses"] = licenses.digest_sql()


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.align(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    written = stored(found.withColumn("groups_sha256", digest).drop("groups"))
    return alignment.scored(written).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                            "groups_sha256")
