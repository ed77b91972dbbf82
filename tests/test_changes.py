"""Change detection: bounds, fan-out, per-entity positions (D-7, D-8, D-12)."""

from __future__ import annotations

from reelsync.operators import changes as C
from reelsync.operators.documents import build_documents

from .conftest import film, make_tables, ts


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_bounds_are_low_exclusive_high_inclusive_and_skip_null(spark):
    t = make_tables(spark, films=[film("a", modified=ts(1)), film("b", modified=ts(2)),
                                  film("c", modified=ts(3)), film("n", modified=None)])
    assert ids(C.changed_since(t.film_work, ts(1), ts(3))) == ["b", "c"]
    assert ids(C.changed_since(t.film_work, None, ts(2))) == ["a", "b"]
    # D-12: a NULL modified is never incremental, but the full load has it
    assert "n" not in ids(C.changed_since(t.film_work, ts(0)))
    assert "n" in ids(build_documents(t))


def test_catch_up_batch_breaks_ties_by_id(spark):
    t = make_tables(spark, films=[film(i, modified=ts(1)) for i in "dcba"] + [film("e", modified=ts(0))])
    assert [r["id"] for r in C.changed_since(t.film_work, None, limit=3).collect()] == ["e", "a", "b"]


def test_exclude_and_accumulate(spark):
    t = make_tables(spark, films=[film(i, modified=ts(1)) for i in "abcd"])
    changed = C.changed_since(t.film_work, ts(0))
    done = C.accumulate_processed(None, C.changed_since(t.film_work, ts(0), limit=2))
    assert ids(C.exclude_processed(changed, done)) == ["c", "d"]
    done = C.accumulate_processed(done, C.exclude_processed(changed, done))
    assert ids(C.exclude_processed(changed, done)) == []


def test_person_without_films_does_not_hide_others(spark):
    """D-7: a changed person without films must not end the pass early."""
    t = make_tables(spark, films=[film("f1"), film("f2")],
                    persons=[("lonely", "L", ts(5)), ("busy", "B", ts(6))],
                    person_links=[("busy", "f2", "actor")])
    changed = C.changed_since(t.person, ts(0))
    assert ids(C.films_by_entity(t, changed, "person")) == ["f2"]


def test_positions_per_entity(spark):
    """D-8: a genre changed later must not move the person position."""
    t = make_tables(spark, films=[film("f1"), film("f2"), film("f3", modified=ts(9))],
                    persons=[("p", "P", ts(2))], person_links=[("p", "f1", "writer")],
                    genres=[("g", "G", ts(7))], genre_links=[("g", "f2"), ("g", "f1")])
    changed = {"person": C.changed_since(t.person, ts(1)),
               "genre": C.changed_since(t.genre, ts(6)),
               "film_work": C.changed_since(t.film_work, ts(8))}
    assert ids(C.affected_films(t, changed)) == ["f1", "f2", "f3"]


def test_dangling_links_are_not_films(spark):
    t = make_tables(spark, films=[film("f1")], persons=[("p", "P", ts(2))],
                    person_links=[("p", "f1", "actor"), ("p", "gone", "actor")])
    assert ids(C.films_by_entity(t, C.changed_since(t.person, ts(1)), "person")) == ["f1"]


def test_current_highs(spark):
    t = make_tables(spark, films=[film("a", modified=ts(1)), film("b", modified=ts(4))],
                    persons=[("p", "P", ts(2))], genres=[])
    highs = {r["entity"]: r["position"] for r in C.current_highs(t, C.ENTITIES).collect()}
    assert highs == {"film_work": ts(4), "person": ts(2), "genre": None}
