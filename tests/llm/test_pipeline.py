"""The pipeline and its stages against plain versions, and the registration."""

import hashlib
import random
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from reelsync.llm import langid, secrets
from reelsync.session import shared_path
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages(spark, documents, tmp_path):
    vocabulary = secrets.dictionary(str(public_tokenizers.path("byte_bpe_50k.json")))
    words = ("das und ist nicht ein", "the of and to that is", "le la et les des")
    folder = "/root/testdata/sf0.001"
    extra = spark.createDataFrame([
        (-1, None, "en", "src0", None), (-2, "12345 !!", "en", "src0", 8), (-3, "", None, None, 0),
        (-4, f"{words[1]} token = 0123456789abcdef0123 {words[1]}", "en", None, 60)], documents.schema)
    docs, kept = documents.unionByName(extra), {}
    columns = documents.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "encode":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    ids = [r.doc_id for r in kept["language_id"]]
    assert not {-1, -2, -3} & set(ids) and -4 in ids
    assert len(ids) >= 0.95 * documents.count()
    # one document of each group, the smallest id
    groups = {}
    of = {r.doc_id: plain_fingerprint(r.text) for r in kept["language_id"]}
    classes = plain_components(of.values())
    for i, fp in of.items():
        groups.setdefault(classes[fp], []).append(i)
    assert sorted(r.doc_id for r in kept["near_dedup"]) == sorted(min(g) for g in groups.values())
    # secrets are masked, other texts stay
    before = {r.doc_id: r.text for r in kept["near_dedup"]}
    for r in kept["secret_scan"]:
        spans = secrets.base_spans(before[r.doc_id])
        guessed = secrets.guess_spans(before[r.doc_id], words=vocabulary)
        assert (r.text == before[r.doc_id]) == (not spans and not guessed)
        assert not secrets.base_spans(r.text) and r.n_chars == len(r.text)
    # repeated, left out, never changed
    texts = {r.doc_id: r.text for r in kept["secret_scan"]}
    times = {}
    for r in kept["mix_sources"]:
        assert r.text == texts[r.doc_id]
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 3
    library = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    assert len(kept["encode"]) == len(kept["mix_sources"])
    for r in kept["encode"]:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(want, skip_special_tokens=False)
        assert r.ids == want and r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_columns_named_like_an_operators_pass_through(spark, documents):
    names = ("size", "source_size", "Target", "copies", "score", "lang_pred")
    docs = documents.withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in names)
        plain = stage(spark, documents, "").collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain)


def test_texts_of_no_learned_language_go_and_clean_ones_stay(spark, documents):
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    junk = {-1: "".join(draw.choice(letters) for _ in range(400)),
            -2: " ".join("".join(draw.choice(letters[:26]) for _ in range(7)) for _ in range(60)),
            -3: "".join(chr(draw.randint(0x4e00, 0x9fff)) for _ in range(100)),
            -4: "".join(chr(draw.randint(33, 126)) for _ in range(400))}
    short = {-5: "Ab.", -6: "x"}  # too little to tell
    extra = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in {**junk, **short}.items()], documents.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, documents.unionByName(extra), "").collect()}
    assert not kept & set(junk)
    clean = {r.doc_id for r in documents.where(F.col("lang").isNotNull() & F.col("text").rlike("[A-Za-z]")).collect()}
    assert clean <= kept


def test_nothing_but_the_result_is_left(spark, documents, tmp_path):
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    base = Path(shared_path(spark, "tables").replace("file:", ""))
    before = set(base.iterdir()) if base.exists() else set()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert (set(base.iterdir()) if base.exists() else set()) == before


def test_stages_of_an_empty_table(spark, empty, tmp_path):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
    assert langid.UNDETERMINED == "und"


def test_every_query_is_registered_and_returns_its_columns(spark):
    want = {
        "op1": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op2": "doc_id size source_size target taken", "op3": "doc_id n_bytes n_tokens over_limit",
        "op4": "doc_id n_assign n_access n_hex base_sha256 spans", "op5": "page_id url text n_chars",
        "op6": "doc_id held_out lang_pred score", "op7": "doc_id fingerprint component_id",
        "op8": "doc_id held_out score predicted", "op9": "query_id rank vec_id score",
        "op10": "doc_id n_tokens ids_sha256 decoded_sha256"}
    queries = __spark_entry__.queries()
    assert "pipeline" in queries
    folder = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    for key, columns in want.items():
        name = next(q for q in queries if q.startswith(key + "_"))
        frame = queries[name](spark, folder)
        assert set(columns.split()) <= set(frame.columns), name
        if "doc_id" in columns:
            assert frame.select(F.count("doc_id")).first()[0] == n, name
