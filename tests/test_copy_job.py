"""The whole copy job: parents first, orphans refused, every table checked."""

from __future__ import annotations

import pytest

from reelsync.operators.copy import OrphanLinks, copy_tables

FILM = ("id string, title string, description string, creation_date string, rating double, "
        "type string, created_at string, updated_at string")
PERSON = "id string, full_name string, created_at string, updated_at string"
PFW = "id string, person_id string, film_work_id string, role string, created_at string"


def sources(spark, links):
    return {
        "film_work": spark.createDataFrame(
            [("f1", "One", None, "2020-01-02", 7.5, "movie", None, "2024-01-01 00:00:00")], FILM),
        "person": spark.createDataFrame([("p1", "Ann", None, None)], PERSON),
        "person_film_work": spark.createDataFrame(links, PFW),
    }


def test_copy_job_twice_is_copy_once(spark, tmp_path):
    src = sources(spark, [("l1", "p1", "f1", "actor", None), ("l2", "p1", "f1", "actor", None),
                          ("l3", None, "f1", None, None), ("l4", None, "f1", None, None)])
    report = {r["table_name"]: (r["source_rows"], r["target_rows"])
              for r in copy_tables(src, str(tmp_path)).collect()}
    # l2 repeats l1's (person, film, role); rows with a NULL key part never conflict
    assert report == {"film_work": (1, 1), "person": (1, 1), "person_film_work": (4, 3)}
    again = {r["table_name"]: r["target_rows"] for r in copy_tables(src, str(tmp_path)).collect()}
    assert again == {"film_work": 1, "person": 1, "person_film_work": 3}


def test_orphans_fail_or_are_dropped(spark, tmp_path):
    src = sources(spark, [("l1", "p1", "f1", "actor", None), ("l2", "ghost", "f1", "actor", None)])
    with pytest.raises(OrphanLinks):
        copy_tables(src, str(tmp_path / "a"))
    report = {r["table_name"]: r["target_rows"]
              for r in copy_tables(src, str(tmp_path / "b"), on_orphans="drop").collect()}
    assert report["person_film_work"] == 1
