"""Rows compared by checksums (D-20) and term counts kept by changes (T-5)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reelsync.operators import copy as C
from reelsync.operators.terms import change_term_df, document_frequency, read_term_df, store_term_df, term_df, text_terms
from reelsync.schemas import TARGETS

from .conftest import ts


def genres(spark, rows):
    return spark.createDataFrame(rows, TARGETS["genre"])


@pytest.fixture(scope="module")
def rows():
    return [(f"g{i}", f"name {i}", None if i % 3 else "about", ts(1), ts(i % 20)) for i in range(500)]


def found(spark, source, target, **kw):
    return sorted(map(tuple, C.unequal_rows("genre", genres(spark, source), genres(spark, target), **kw).collect()))


def test_altered_rows_are_named(spark, rows):
    other = list(rows)
    other[3] = ("g3", "name 3", "About", ts(1), ts(3))
    other[7] = ("g7", "name 7", "\\N?", ts(1), ts(7))
    other[9] = ("g9x", *rows[9][1:])
    want = [("g3", "altered"), ("g7", "altered"), ("g9", "missing"), ("g9x", "extra")]
    assert found(spark, rows, other) == found(spark, rows, other, places=4) == want
    assert found(spark, rows, list(reversed(rows))) == []
    assert found(spark, [], rows[:2]) == [("g0", "extra"), ("g1", "extra")]
    assert found(spark, rows[:1] * 2, rows[:1]) == [("g0", "altered")]  # a repeated key counts


def test_equal_buckets_are_not_compared_by_key(spark, rows):
    source, target = genres(spark, rows), genres(spark, rows[:-1] + [("g499", "x", None, ts(1), ts(1))])
    plan = C.unequal_rows("genre", source, target, places=64)._jdf.queryExecution().optimizedPlan().toString()
    assert "place" not in plan.split("\n")[0] and plan.count("Filter") >= 2
    place = F.pmod(F.xxhash64("id"), F.lit(64)).cast("int")
    one = source.where(F.col("id") == "g499").select(place).first()[0]
    assert str(one) in plan  # the one unequal bucket is what both sides are cut to
    same = C.unequal_rows("genre", source, source, places=64)
    assert "LocalRelation <empty>" in same._jdf.queryExecution().optimizedPlan().toString()


def test_term_counts_by_changes(spark, tmp_path):
    def texts(rows):
        return spark.createDataFrame(rows, "id long, text string")

    before = [(1, "the red fox"), (2, "red dog dog"), (3, None), (4, ""), (5, "lonely term")]
    after = [(1, "the blue fox"), (2, "red dog dog"), (3, "red"), (4, "fox"), (6, "dog")]
    path = str(tmp_path / "df")
    store_term_df(texts(before), path, "text")
    changed = lambda rows, other: texts([r for r in rows if r not in other])
    change_term_df(changed(before, after), changed(after, before), path, "text")
    want = sorted(map(tuple, term_df(text_terms(texts(after), "id", "text")).collect()))
    assert sorted(map(tuple, read_term_df(spark, path).collect())) == want
    assert "lonely" not in dict(want)
    odd = texts([(1, "dog's dog 'dog' DOG's"), (2, "the the"), (3, "it's o'clock")])
    assert sorted(map(tuple, document_frequency(odd, "text").collect())) == \
        sorted(map(tuple, term_df(text_terms(odd, "id", "text")).collect()))
    change_term_df(texts([]), texts([]), path, "text")  # nothing changed
    assert sorted(map(tuple, read_term_df(spark, path).collect())) == want
