"""Strict schemas, projection, coercion (P-1..P-3, section 1.4)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from reelsync.operators.copy import coerce, coerce_or_reject, copy_table, key_parity, project_source
from reelsync.schemas import PERSON, SchemaMismatch, check_strict

SRC = "id string, full_name string, created_at string, updated_at string, extra int"


def test_nested_mismatch_is_reported():
    want = T.StructType([T.StructField("a", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType())])))])
    have = T.StructType([T.StructField("a", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("x", T.IntegerType())])))])
    with pytest.raises(SchemaMismatch, match="a.x: not in the schema"):
        check_strict(have, want)
    check_strict(want, want)


def test_project_rename_cast(spark):
    src = spark.createDataFrame([("1", "Ann", "2024-01-01 10:00:00", None, 5)], SRC)
    rows = coerce(project_source(src, "person"), "person")
    check_strict(rows.schema, PERSON)
    r = rows.collect()[0]
    assert r["created"] == dt.datetime(2024, 1, 1, 10, 0) and r["modified"] is None


def test_missing_source_column_raises(spark):
    src = spark.createDataFrame([("1", "Ann")], "id string, full_name string")
    with pytest.raises(SchemaMismatch, match="created_at"):
        project_source(src, "person")


def test_bad_text_raises_or_is_rejected(spark):
    src = spark.createDataFrame([("1", "Ann", "not a time", None, 0),
                                 ("2", "Bo", "2024-01-02", None, 0)], SRC)
    with pytest.raises(Exception):
        coerce(project_source(src, "person"), "person").collect()
    good, bad = coerce_or_reject(project_source(src, "person"), "person")
    assert [r["id"] for r in good.collect()] == ["2"]
    assert [r["id"] for r in bad.collect()] == ["1"]


def test_copy_and_key_parity(spark):
    src = spark.createDataFrame([("1", "Ann", None, None, 0), ("1", "Ann2", None, None, 0),
                                 ("2", "Bo", None, None, 0)], SRC)
    target = spark.createDataFrame([("2", "Bo", None, None)], PERSON)
    new = copy_table("person", src, target)
    assert [(r["id"], r["full_name"]) for r in new.collect()] == [("1", "Ann")]
    report = {r["check"]: r["n"] for r in key_parity(
        project_source(src, "person"), target, ["id"]).collect()}
    assert report == {"missing_in_target": 2, "only_in_target": 0}
