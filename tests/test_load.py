"""Full load, incremental passes and restarts (R-2, D-8..D-12, section 5.2)."""

from __future__ import annotations

from reelsync.operators import sinks
from reelsync.operators import state as S
from reelsync.operators.documents import build_documents
from reelsync.plans.load import SyncPaths, full_load, incremental_pass

from .conftest import film, make_tables, ts


def snapshot(spark, path):
    return sorted(tuple(str(v) for v in r) for r in sinks.read_current(spark, path).collect())


def world(spark, names=None, titles=None, genre_name="Drama", pmod=None, fmod=None, gmod=ts(1)):
    names = names or {"p1": "Ann", "p2": "Bob"}
    titles = titles or {"f1": "One", "f2": "Two", "f3": "Three"}
    pmod = pmod or {"p1": ts(1), "p2": ts(1)}
    fmod = fmod or {"f1": ts(1), "f2": ts(1), "f3": None}
    return make_tables(
        spark,
        films=[film(f, t, fmod[f]) for f, t in titles.items()],
        persons=[(p, n, pmod[p]) for p, n in names.items()],
        person_links=[("p1", "f1", "actor"), ("p2", "f2", "director"), ("p1", "f2", "writer")],
        genres=[("g1", genre_name, gmod)], genre_links=[("g1", "f1"), ("g1", "f3")])


def expected(t):
    return sorted(tuple(str(v) for v in r) for r in build_documents(t).collect())


def test_first_run_is_full_load_then_incremental(spark, tmp_path):
    paths = SyncPaths(str(tmp_path / "docs"), str(tmp_path / "pos"))
    t1 = world(spark)
    r1 = incremental_pass(t1, paths)
    assert r1.pass_id == 1 and snapshot(spark, paths.documents) == expected(t1)
    # nothing changed: the pass upserts nothing and keeps the version
    r2 = incremental_pass(t1, paths)
    assert r2.version == r1.version and r2.pass_id == 2
    # a person and a genre change at different times (D-8)
    t2 = world(spark, names={"p1": "Anna", "p2": "Bob"}, pmod={"p1": ts(3), "p2": ts(1)},
               genre_name="Noir", gmod=ts(2))
    incremental_pass(t2, paths)
    assert snapshot(spark, paths.documents) == expected(t2)
    pos = S.as_dict(S.merge_positions(S.empty_positions(spark), S.read_positions(spark, paths.positions)))
    assert pos == {"person": ts(3), "genre": ts(2), "film_work": ts(1)}


def test_split_change_log_equals_one_pass(spark, tmp_path):
    base = world(spark)
    step1 = world(spark, titles={"f1": "Uno", "f2": "Two", "f3": "Three"},
                  fmod={"f1": ts(2), "f2": ts(1), "f3": None})
    step2 = world(spark, titles={"f1": "Uno", "f2": "Dos", "f3": "Three"},
                  fmod={"f1": ts(2), "f2": ts(3), "f3": None},
                  names={"p1": "Ann", "p2": "Rob"}, pmod={"p1": ts(1), "p2": ts(4)})
    a = SyncPaths(str(tmp_path / "a_docs"), str(tmp_path / "a_pos"))
    b = SyncPaths(str(tmp_path / "b_docs"), str(tmp_path / "b_pos"))
    full_load(base, a)
    incremental_pass(step1, a)
    incremental_pass(step2, a)
    full_load(base, b)
    incremental_pass(step2, b)
    assert snapshot(spark, a.documents) == snapshot(spark, b.documents) == expected(step2)


def test_crash_between_sink_and_positions_repeats_harmlessly(spark, tmp_path):
    """D-10: the sink committed but the positions were not saved."""
    paths = SyncPaths(str(tmp_path / "docs"), str(tmp_path / "pos"))
    full_load(world(spark), paths)
    t2 = world(spark, names={"p1": "Anna", "p2": "Bob"}, pmod={"p1": ts(3), "p2": ts(1)})
    sinks.upsert(build_documents(t2), paths.documents, ["id"])     # crash right after this
    incremental_pass(t2, paths)                                     # rerun
    assert snapshot(spark, paths.documents) == expected(t2)


def test_bounded_passes_catch_up(spark, tmp_path):
    """O-1: passes of at most two changes per entity reach the same state."""
    paths = SyncPaths(str(tmp_path / "docs"), str(tmp_path / "pos"))
    full_load(world(spark), paths)
    t2 = world(spark, titles={"f1": "Uno", "f2": "Dos", "f3": "Tres"},
               fmod={"f1": ts(2), "f2": ts(3), "f3": ts(3)},
               names={"p1": "Anna", "p2": "Rob"}, pmod={"p1": ts(2), "p2": ts(4)})
    r = incremental_pass(t2, paths, max_changes=1)
    assert r.positions["film_work"] == ts(2) and r.positions["person"] == ts(2)
    r = incremental_pass(t2, paths, max_changes=1)
    # f2 and f3 share ts(3): both are taken, ties are not split
    assert r.positions["film_work"] == ts(3) and r.positions["person"] == ts(4)
    assert snapshot(spark, paths.documents) == expected(t2)
