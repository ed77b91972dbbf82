"""A training-data pipeline over ``documents``: five stages, each one operator.

Every stage takes what its predecessor kept, and its decisions take effect:
texts of no recognisable language go (none predicted, or too unlike what was
learned for a text of any), one document of each near-duplicate group stays, secrets are masked in the text, sources are mixed to their target
weights (documents are repeated or left out), and the rest is encoded.

``STAGES`` are functions of (spark, docs, sf_dir); ``run`` writes each stage's
result as Parquet below ``spark.checkpoint.dir`` and reads it again, so that a
lost executor repeats one stage at most; the tables that a stage needed on the
way are removed once it is written.

Rows are kept as they are: a repeated row is a document of its own to every
stage (near-duplicate ones go in ``near_dedup``), all columns pass through
whatever their names, and an empty table gives an empty table. A NULL text has
no language and goes in the first stage; the later ones read it as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsync.llm import bpe, langid, mixing, secrets, simhash
from reelsync.llm.queries import table, tokenizer
from reelsync.llm.shared import scratch
from reelsync.session import remove_path, shared_path

MIN_SCORE = 0.3  # least probability of the predicted language; a short clean text has little evidence
MAX_RATE = 5.0   # bits a byte, at most, under the predicted language; its own prose takes 2 to 3, noise 6 and more
SLACK = 128.0    # and bits beside that, for what a short text holds of names and numbers


def apart(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with all columns but ``needed`` under private names, which no
    column that an operator adds or replaces has."""
    return docs.toDF(*[c if c.lower() in needed else f"_pipeline_{i}" for i, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised (operator 6): one is predicted,
    is not improbable beside the others, and codes the text in at most
    ``MAX_RATE`` bits a byte and ``SLACK``. Texts that are NULL, empty or without
    a letter go; ties of languages fall to the smaller name and their documents
    stay. If no row has a language, nothing is recognised."""
    learn, held = docs.select("doc_id", "text", "lang"), apart(docs, "doc_id", "text", "lang")
    found = langid.identify(held, learn, bits="_pipeline_bits")
    sure = ((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
            & (F.col("_pipeline_bits") <= MAX_RATE * F.octet_length("text") + SLACK))
    return found.where(sure).select(*held.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id
    (operator 7, three words and three bits). NULL, empty and blank texts have
    the same fingerprint and are one group; of rows with the same id one stays."""
    held = apart(docs, "doc_id", "text")
    return simhash.keep_one(held, words=3, bits=3).select(*held.columns).toDF(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked (operator 4); NULL
    stays NULL, and ``n_chars`` is recounted."""
    return secrets.redact(docs, vocabulary=tokenizer("byte_bpe_50k.json")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out towards the sources' targets (operator 2)."""
    held = apart(docs, "doc_id", "text", "source")
    return mixing.emit(mixing.mix(held)).select(*held.columns).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of what they decode to
    (operator 10)."""
    path = tokenizer("word_bpe_49k.json")
    coded = bpe.encode(docs.select("doc_id", "text"), path, drop=("text",), decoded=True)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("secret_scan", secret_scan),
          ("mix_sources", mix_sources), ("encode", encode)]

#: Not expressible: language models, fingerprints and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    base = shared_path(spark, "pipeline", unique=True)
    for name, stage in STAGES:
        path = f"{base}/{name}"
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove_path(spark, before)  # what it held is in the new table
        before = path
    return docs
