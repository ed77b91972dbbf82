"""Operator 6: exact code lengths, held-out accuracy, edge rows."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reelsync.llm import langid as L


def rows_of(samples):
    """(lang, gram, n) of texts, counted one byte at a time."""
    counts = {}
    for lang, text in samples:
        data = bytes([L.START] * L.ORDER) + text.encode()
        for i in range(L.ORDER, len(data)):
            gram = int.from_bytes(data[i - L.ORDER:i + 1], "big")
            counts[lang, gram] = counts.get((lang, gram), 0) + 1
    return [(lang, gram, n) for (lang, gram), n in counts.items()]


def plain_bits(samples, lang, text):
    """The code length by its definition, from the training texts."""
    follows = {}
    for name, sample in samples:
        if name == lang:
            data = bytes([L.START] * L.ORDER) + sample.encode()
            for i in range(L.ORDER, len(data)):
                for order in range(L.ORDER + 1):
                    after = follows.setdefault(data[i - order:i], {})
                    after[data[i]] = after.get(data[i], 0) + 1
    data, bits = bytes([L.START] * L.ORDER) + text.encode(), 0.0
    for i in range(L.ORDER, len(data)):
        for order in range(L.ORDER, -1, -1):
            after = follows.get(data[i - order:i])
            if after is None:
                continue
            total = sum(after.values()) + len(after)
            if data[i] in after:
                bits -= math.log2(after[data[i]] / total)
                break
            bits -= math.log2(len(after) / total)
        else:
            bits += 8
    return bits


SAMPLES = [("en", "the cat and the dog"), ("en", "then there was light"), ("de", "der Hund und die Katze"), ("fr", "été")]


def test_code_lengths_are_exact():
    trees = L.ContextTrees(rows_of(SAMPLES))
    texts = ["the dog", "und", "x", "", "été là", "\n\nthe", "a" * 50, "漢字"]
    got = L.Scorer(trees).code_lengths(pa.array(texts))
    want = [[plain_bits(SAMPLES, lang, t) for lang in trees.langs] for t in texts]
    assert np.allclose(got, want, rtol=1e-4)


def test_a_tiny_table_gives_the_same_code_lengths(monkeypatch):
    trees, texts = L.ContextTrees(rows_of(SAMPLES)), pa.array(["the dog and the cat " * 5, "der", "été"])
    want = L.Scorer(trees).code_lengths(texts)
    monkeypatch.setattr(L, "SLOTS_LOG2", 3)
    assert np.allclose(L.Scorer(trees).code_lengths(texts), want)
    monkeypatch.setattr(L, "PIECE", 7)
    assert np.allclose(L.Scorer(trees).code_lengths(texts), want)


def test_gram_counts_match_a_plain_count(spark):
    got = {(r.lang, r.gram): r.n for r in L.gram_counts(spark.createDataFrame(SAMPLES, "lang string, text string")).collect()}
    assert got == {(lang, gram): n for lang, gram, n in rows_of(SAMPLES)}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = L.identify(docs, docs.where(~held)).where(held).collect()
    assert len(found) > 100
    assert sum(r.lang == r.lang_pred for r in found) / len(found) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_edge_rows(edge, empty, documents):
    clash = edge.withColumns({"lang_pred": F.lit(1), "Score": F.lit("x")})
    got = L.identify(clash, documents).collect()
    assert len(got) == edge.count()
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert L.identify(empty, documents).collect() == []
    assert {(r.lang_pred, r.score) for r in L.identify(edge, empty).collect()} == {("und", 0.0)}


def test_the_training_sample_is_bounded(documents):
    sizes = L.training_sample(documents.where("lang = 'en'"), per_lang=20).count()
    assert 0 < sizes <= 60


def test_code_lengths_as_a_column(spark, documents):
    learn = documents.select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 !")], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(extra)
    plain = {r.doc_id: r for r in L.identify(docs, learn).collect()}
    for r in L.identify(docs, learn, bits="bits").collect():
        assert (r.lang_pred, r.score) == (plain[r.doc_id].lang_pred, plain[r.doc_id].score)
        assert (r.bits is None) == (r.lang_pred == L.UNDETERMINED)
        assert r.bits is None or 0 < r.bits < 8.5 * len(r.text.encode()) + 64
