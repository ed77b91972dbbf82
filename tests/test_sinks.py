"""Upsert, strict targets, bulk records, the pluggable writer (S-5..S-8)."""

from __future__ import annotations

import json

import pytest

from reelsync.operators import sinks
from reelsync.schemas import DOCUMENT, SchemaMismatch

SCHEMA = "id string, v int, payload string"


def table(spark, path):
    return sorted(tuple(r) for r in sinks.read_current(spark, path).collect())


def test_upsert_latest_wins_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, "a1"), ("b", 1, "b1")], SCHEMA)
    assert sinks.upsert(first, path, ["id"], ["v"]) == 1
    upd = spark.createDataFrame([("a", 2, "a2"), ("b", 0, "stale"), ("c", 1, "c1"),
                                 ("c", 3, "c3")], SCHEMA)
    assert sinks.upsert(upd, path, ["id"], ["v"]) == 2
    after = table(spark, path)
    assert after == [("a", 2, "a2"), ("b", 1, "b1"), ("c", 3, "c3")]
    sinks.upsert(upd, path, ["id"], ["v"])          # replay of the same batch
    assert table(spark, path) == after


def test_keyed_replace_without_version(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([("a", 5, "old")], SCHEMA), path, ["id"])
    sinks.upsert(spark.createDataFrame([("a", 1, "new")], SCHEMA), path, ["id"])
    assert table(spark, path) == [("a", 1, "new")]


def test_tie_goes_to_update(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([("a", 1, "old")], SCHEMA), path, ["id"], ["v"])
    sinks.upsert(spark.createDataFrame([("a", 1, "new")], SCHEMA), path, ["id"], ["v"])
    assert table(spark, path) == [("a", 1, "new")]


def test_empty_update_makes_no_version(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([("a", 1, "x")], SCHEMA), path, ["id"])
    assert sinks.upsert(spark.createDataFrame([], SCHEMA), path, ["id"]) == 1


def test_strict_schema_rejects_extra_and_missing(spark, tmp_path):
    path = str(tmp_path / "docs")
    sinks.ensure_target(spark, path, DOCUMENT)
    sinks.ensure_target(spark, path, DOCUMENT)       # exists: no new version
    assert sinks.current_version(spark, path) == 1
    docs = spark.createDataFrame([], DOCUMENT)
    with pytest.raises(SchemaMismatch, match="not in the schema"):
        sinks.upsert(docs.withColumn("extra", docs["id"]), path, ["id"], schema=DOCUMENT)
    with pytest.raises(SchemaMismatch, match="missing"):
        sinks.upsert(docs.drop("genre"), path, ["id"], schema=DOCUMENT)


def test_bulk_records_lines(spark, tmp_path):
    docs = spark.createDataFrame(
        [("7", 8.5, None, "T", None, "", "A,B", "", [("1", "A"), ("2", "B")], [])], DOCUMENT)
    rec = sinks.bulk_records(docs, "movies").collect()[0]
    assert json.loads(rec["action"]) == {"index": {"_index": "movies", "_id": "7"}}
    src = json.loads(rec["source"])
    assert src["actors"] == [{"id": "1", "name": "A"}, {"id": "2", "name": "B"}]
    assert src["genre"] is None and src["imdb_rating"] == 8.5
    out = str(tmp_path / "bulk")
    sinks.write_bulk(docs, out, "movies")
    lines = [r["value"] for r in spark.read.text(out).collect()]
    assert len(lines) == 2 and json.loads(lines[0])["index"]["_id"] == "7"


def test_write_documents_skips_empty(spark):
    calls = []
    assert sinks.write_documents(spark.createDataFrame([], DOCUMENT), calls.append) is None
    assert calls == []


def test_write_documents_through_sinks(spark, tmp_path):
    """S-8: the same writer feeds the versioned table and the bulk files."""
    docs = spark.createDataFrame(
        [("1", 7.0, "Drama", "T", None, "D", "A", "", [("p", "A")], [])], DOCUMENT)
    table = str(tmp_path / "docs")
    assert sinks.write_documents(docs, sinks.parquet_upsert_sink(table, schema=DOCUMENT)) == 1
    assert sinks.read_current(spark, table).count() == 1
    bulk = str(tmp_path / "bulk")
    sinks.write_documents(docs, sinks.bulk_file_sink(bulk, "movies"))
    assert spark.read.text(bulk).count() == 2
