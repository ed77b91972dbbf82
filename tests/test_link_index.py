"""The link index: same films as all links, files read follow the changed ids."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reelsync.operators import sinks
from reelsync.operators.changes import affected_films, films_by_entity
from reelsync.plans.load import SyncPaths, full_load, incremental_pass
from reelsync.sources.link_index import LinkIndex

from .conftest import film, make_tables, ts


@pytest.fixture(scope="module")
def tables(spark):
    return make_tables(
        spark, films=[film(f"f{i}", modified=ts(1)) for i in range(200)],
        persons=[(f"p{i}", f"P{i}", ts(1)) for i in range(100)],
        person_links=[(f"p{i % 100}", f"f{i}", "actor") for i in range(200)] * 2 + [(None, "f1", "actor"), ("p1", None, "x")]
        + [("p5", f"f{i}", "writer") for i in range(200)],
        genres=[("g1", "G", ts(1))], genre_links=[("g1", f"f{i}") for i in range(50)])


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_same_films_and_few_files(spark, tables, tmp_path):
    index = LinkIndex(str(tmp_path / "index"), places=32)
    index.build(tables)
    for wanted in (["p3"], ["p3", "p77", "p99"], ["p5"], ["nobody"], [None, "p3"], []):
        changed = spark.createDataFrame([(w,) for w in wanted], "id string")
        assert ids(films_by_entity(tables, changed, "person", index)) == ids(films_by_entity(tables, changed, "person"))
        files = index.linked_film_ids(changed, "person").inputFiles()
        read = {f.split("__place=")[1].split("/")[0] for f in files if "__place=" in f}
        real = spark.createDataFrame([(w,) for w in wanted if w], "id string")
        assert read <= {str(r[0]) for r in real.select(index._place(F.col("id"))).collect()}
    changes = {"person": tables.person.where("id = 'p7'").select("id"), "genre": tables.genre.select("id"),
               "film_work": tables.film_work.where("id = 'f150'").select("id")}
    assert ids(affected_films(tables, changes, index)) == ids(affected_films(tables, changes))


def test_links_added_and_taken_out(spark, tables, tmp_path):
    index = LinkIndex(str(tmp_path / "index"), places=4)
    index.build(tables)
    changed = spark.createDataFrame([("p3",)], "id string")
    more = spark.createDataFrame([("x", "p3", "f9", "actor", None)], tables.person_film_work.schema)
    index.add(more, "person")
    assert "f9" in ids(index.linked_film_ids(changed, "person"))
    index.build(tables)  # from the tables as they are: the link is not among them
    assert "f9" not in ids(index.linked_film_ids(changed, "person"))
    assert len(index._builds(spark)) == 2
    index.build(tables)
    assert len(index._builds(spark)) == 2  # the first one went
    with pytest.raises(ValueError, match="places"):
        LinkIndex(index.root, places=5).linked_film_ids(changed, "person")


def test_an_incremental_pass_through_the_index(spark, tmp_path):
    def world(name, day):
        return make_tables(spark, films=[film("f1", modified=ts(1)), film("f2", modified=ts(1))],
                           persons=[("p1", name, ts(day))], person_links=[("p1", "f2", "actor")])

    paths = SyncPaths(str(tmp_path / "docs"), str(tmp_path / "pos"))
    full_load(world("Ann", 1), paths)
    index = LinkIndex(str(tmp_path / "index"))
    index.build(world("Ann", 1))
    assert incremental_pass(world("Anna", 2), paths, index=index).documents == 1
    assert {r["id"]: r["actors_names"] for r in sinks.read_current(spark, paths.documents).collect()} == {"f1": "", "f2": "Anna"}
