"""Q-2..Q-4 on inline rows with NULLs and orphans."""

from __future__ import annotations

from reelsync.operators.quality import constraint_report, orphan_report, prune_links

from .conftest import film, make_tables


def test_orphans_and_pruning(spark):
    t = make_tables(spark, films=[film("f1")], persons=[("p1", "x" * 251, None)],
                    person_links=[("p1", "f1", "actor"), ("ghost", "f1", "actor"),
                                  (None, "f1", "actor")],
                    genres=[("g1", "G", None)], genre_links=[("g1", "gone")])
    report = {(r["table_name"], r["column_name"]): r["orphans"]
              for r in orphan_report(t.as_dict()).collect()}
    assert report[("person_film_work", "person_id")] == 1   # NULL is not an orphan
    assert report[("genre_film_work", "film_work_id")] == 1
    assert report[("genre_film_work", "genre_id")] == 0
    pruned = prune_links(t.as_dict())
    assert sorted(r["person_id"] or "-" for r in pruned["person_film_work"].collect()) == ["-", "p1"]
    assert pruned["genre_film_work"].count() == 0
    checks = {(r["table_name"], r["column_name"], r["rule"]): r["violations"]
              for r in constraint_report(t.as_dict()).collect()}
    assert checks[("person", "full_name", "max_length_250")] == 1
    assert checks[("film_work", "title", "not_null")] == 0
