"""Deletes through links and documents (Q-4), backlogs cut into passes (O-1, O-4)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reelsync.operators import changes as C
from reelsync.operators import sinks
from reelsync.operators.dedupe import keep_first_keys
from reelsync.operators.documents import build_documents
from reelsync.operators.quality import prune_links
from reelsync.plans.load import SyncPaths, catch_up, full_load, remove_entities, slice_backlog
from reelsync.sources.link_index import LinkIndex

from .conftest import film, make_tables, ts

SCHEMA = "id long, v int"


def rows(spark, path):
    return sorted(map(tuple, sinks.read_current(spark, path).collect()))


@pytest.mark.parametrize("share", [0.5, 100.0])
def test_deletes_and_upserts_in_any_order(spark, tmp_path, share):
    draw, path, want = random.Random(5), str(tmp_path / "t"), {}
    assert sinks.delete(spark.createDataFrame([(1,)], "id long"), path) == 0  # there is no table
    for step in range(8):
        some = {draw.randrange(25) for _ in range(6)}
        if step % 2:
            sinks.delete(spark.createDataFrame([(k,) for k in some] * 2, "id long"), path, share=share, layers=2)
            want = {k: v for k, v in want.items() if k not in some}
        else:
            sinks.upsert(spark.createDataFrame([(k, step) for k in some], SCHEMA), path, ["id"], buckets=3, share=share, layers=2)
            want.update(dict.fromkeys(some, step))
        assert rows(spark, path) == sorted(want.items())
    sinks.rebucket(spark, path, 5)
    assert rows(spark, path) == sorted(want.items())
    sinks.delete(spark.range(25), path)
    assert rows(spark, path) == []
    sinks.upsert(spark.createDataFrame([(1, 1)], SCHEMA), path, ["id"])
    assert rows(spark, path) == [(1, 1)]


def test_a_delete_of_an_earlier_version_loses(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark.createDataFrame([(1, 5), (2, 5)], SCHEMA), path, ["id"], ["v"])
    sinks.delete(spark.createDataFrame([(1, 4), (2, 5)], SCHEMA), path, share=100)
    assert rows(spark, path) == [(1, 5)]


def world(spark):
    return make_tables(
        spark, films=[film(f"f{i}", modified=ts(i)) for i in range(6)],
        persons=[(f"p{i}", f"P{i}", ts(1)) for i in range(3)],
        person_links=[("p0", "f0", "actor"), ("p1", "f0", "actor"), ("p1", "f1", "director"), ("p2", "f2", "writer")],
        genres=[("g0", "A", ts(1)), ("g1", "B", ts(1))], genre_links=[("g0", "f0"), ("g1", "f0"), ("g0", "f3")])


def test_removed_parents_leave_the_documents(spark, tmp_path):
    t = world(spark)
    paths = SyncPaths(str(tmp_path / "docs"), str(tmp_path / "pos"))
    full_load(t, paths)
    index = LinkIndex(str(tmp_path / "index"))
    index.build(t)
    removed = {"person": t.person.where("id = 'p1'").select("id"), "genre": t.genre.where("id = 'g0'").select("id"),
               "film_work": t.film_work.where("id in ('f2', 'f5')").select("id")}
    remove_entities(t, removed, paths, index)
    kept = t.replace(person=t.person.where("id <> 'p1'"), genre=t.genre.where("id <> 'g0'"),
                     film_work=t.film_work.where("id not in ('f2', 'f5')"))
    want = build_documents(kept.replace(**prune_links(kept.as_dict())))
    assert sorted(map(str, sinks.read_current(spark, paths.documents).collect())) == sorted(map(str, want.collect()))


def test_slices_are_even_and_cover_the_backlog(spark):
    draw = random.Random(3)
    t = make_tables(spark, films=[film(f"f{i}", modified=ts(draw.randrange(400), draw.randrange(24))) for i in range(3_000)]
                    + [film("undated")], persons=[("p", "P", ts(5))], genres=[])
    low = {"film_work": ts(40), "person": ts(1), "genre": None}
    high = {"film_work": ts(399, 23), "person": ts(5), "genre": None}
    slices = slice_backlog(t, low, high, 250)
    sizes, at = [], ts(40)
    for bounds in slices:
        sizes.append(C.changed_since(t.film_work, at, bounds["film_work"]).count())
        at = bounds["film_work"]
        assert bounds["person"] == ts(5) and "genre" not in bounds
    assert at == ts(399, 23) and sum(sizes) == C.changed_since(t.film_work, ts(40), ts(399, 23)).count()
    assert max(sizes) <= 275 and min(sizes) >= 200
    assert slice_backlog(t, high, high, 250)[-1]["film_work"] == high["film_work"]
    many = make_tables(spark, films=[film(f"f{i}", modified=ts(9)) for i in range(100)])  # one time: never split
    assert slice_backlog(many, {"film_work": ts(1)}, {"film_work": ts(9)}, 10) == [{"film_work": ts(9)}]


def test_catching_up_equals_one_load(spark, tmp_path):
    paths = SyncPaths(str(tmp_path / "docs"), str(tmp_path / "pos"))
    old = world(spark)
    assert len(catch_up(old.replace(film_work=old.film_work.where("id < 'f2'")), paths, 2)) == 1  # the first run: a full load
    results = catch_up(old, paths, 2)
    assert [r.documents for r in results] == [2, 2]
    assert rows(spark, paths.documents) == sorted(map(tuple, build_documents(old).collect()))


def test_keep_first_without_rivals_and_without_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, n string")
    assert keep_first_keys(df, [["k"], ["n"]]).count() == 3
    assert keep_first_keys(df.where(F.lit(False)), [["k"], ["n"]]).collect() == []
    assert keep_first_keys(spark.createDataFrame([], df.schema), [["k"], ["n"]]).collect() == []
