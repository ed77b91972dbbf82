from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelsync.session import build_session  # noqa: E402
from reelsync.sources.film import FilmTables  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ck = tmp_path_factory.mktemp("checkpoints")
    session = build_session("local[*]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": str(ck),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    yield session
    session.stop()


FILM_SCHEMA = ("id string, title string, description string, creation_date date, "
               "rating double, type string, created timestamp_ntz, modified timestamp_ntz")
PERSON_SCHEMA = "id string, full_name string, created timestamp_ntz, modified timestamp_ntz"
GENRE_SCHEMA = ("id string, name string, description string, created timestamp_ntz, "
                "modified timestamp_ntz")
PFW_SCHEMA = "id string, person_id string, film_work_id string, role string, created timestamp_ntz"
GFW_SCHEMA = "id string, genre_id string, film_work_id string, created timestamp_ntz"

T0 = dt.datetime(2024, 1, 1)


def ts(day: int, hour: int = 0) -> dt.datetime:
    return T0 + dt.timedelta(days=day, hours=hour)


def film(fid, title="t", modified=None, rating=1.0):
    return (fid, title, None, None, rating, "movie", modified, modified)


def make_tables(spark, films, persons=(), person_links=(), genres=(), genre_links=()):
    """Inline film-domain tables. ``person_links`` are (person_id, film_id,
    role); ``genre_links`` (genre_id, film_id); persons (id, name, modified);
    genres (id, name, modified)."""
    return FilmTables(
        film_work=spark.createDataFrame(list(films), FILM_SCHEMA),
        person=spark.createDataFrame([(p, n, m, m) for p, n, m in persons], PERSON_SCHEMA),
        person_film_work=spark.createDataFrame(
            [(f"pl{i}", p, f, r, None) for i, (p, f, r) in enumerate(person_links)], PFW_SCHEMA),
        genre=spark.createDataFrame([(g, n, None, m, m) for g, n, m in genres], GENRE_SCHEMA),
        genre_film_work=spark.createDataFrame(
            [(f"gl{i}", g, f, None) for i, (g, f) in enumerate(genre_links)], GFW_SCHEMA),
    )
