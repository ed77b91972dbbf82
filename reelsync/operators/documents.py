"""Enrichment and nesting: films -> one nested document each.

Two forms:

* :func:`enrich_fanout` is the four left joins (film x person links x genre
  links), one row per (person link, genre link) pair of a film.
* :func:`build_documents` aggregates each link branch to one row per film
  *before* joining it to the film. The document fields are all duplicate-
  insensitive (distinct persons, max, min), so this equals nesting the fan-out
  but never materialises persons x genres rows. Both branch aggregates come
  out hash-partitioned by film id, so the final two joins only shuffle the
  film table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.docs import (names_text, or_empty_list, or_empty_text, person_ref,
                              refs_as_string_ids, sorted_refs, when_role)
from ..schemas import ROLE_ACTOR, ROLE_DIRECTOR, ROLE_WRITER
from ..sources.film import FilmTables


def restrict_to(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    """P-7 / J-8: keep rows whose ``key`` is among ``ids`` (column ``id``).
    A semi join: no duplicates from repeated ids, NULL keys never match."""
    if ids is None:
        return df
    wanted = ids.select(F.col("id").alias("__id"))
    return df.join(wanted, df[key] == wanted["__id"], "left_semi")


def first_film_ids(film: DataFrame, n: int) -> DataFrame:
    """O-3: the first ``n`` film ids in id order (a top-n, not a row cap)."""
    return film.select("id").orderBy("id").limit(n)


def _restricted(tables: FilmTables, ids: DataFrame | None, limit: int | None) -> FilmTables:
    if limit is not None:
        ids = first_film_ids(restrict_to(tables.film_work, ids, "id"), limit)
    if ids is None:
        return tables
    # The id set restricts the film scan *and* both link scans, so links of
    # untouched films never reach the person / genre joins. It is used three
    # times: a caller whose set is costly hands in a written one.
    ids = ids.select("id")
    return tables.replace(
        film_work=restrict_to(tables.film_work, ids, "id"),
        person_film_work=restrict_to(tables.person_film_work, ids, "film_work_id"),
        genre_film_work=restrict_to(tables.genre_film_work, ids, "film_work_id"),
    )


def enrich_fanout(tables: FilmTables, ids: DataFrame | None = None,
                  limit: int | None = None) -> DataFrame:
    """J-1..J-4, P-8, P-10: the enrichment rows, 11 columns."""
    t = _restricted(tables, ids, limit)
    # Each link meets its person or genre before it meets the film, so both
    # dimensions are joined to link rows, not to the multiplied ones, and the
    # two joins on the film id share its partitioning.
    p = t.person.select(F.col("id").alias("p_id"), F.col("full_name").alias("p_name"))
    pfw = t.person_film_work.select(F.col("film_work_id").alias("pfw_film_work_id"),
                                    F.col("person_id").alias("pfw_person_id"),
                                    F.col("role").alias("pfw_role"))
    g = t.genre.select(F.col("id").alias("g_id"), F.col("name").alias("g_name"))
    gfw = t.genre_film_work.select(F.col("film_work_id").alias("gfw_film_work_id"),
                                   F.col("genre_id").alias("gfw_genre_id"))
    fw = t.film_work.select(*[F.col(c).alias(f"fw_{c}") for c in t.film_work.columns])
    people = pfw.join(p, pfw["pfw_person_id"] == p["p_id"], "left")
    genres = gfw.join(g, gfw["gfw_genre_id"] == g["g_id"], "left")
    return (fw
            .join(people, fw["fw_id"] == people["pfw_film_work_id"], "left")
            .join(genres, fw["fw_id"] == genres["gfw_film_work_id"], "left")
            .select(F.col("fw_id").alias("id"), F.col("fw_title").alias("title"),
                    F.col("fw_description").alias("description"),
                    F.col("fw_rating").alias("rating"), F.col("fw_type").alias("type"),
                    F.col("fw_created").alias("created"),
                    F.col("fw_modified").alias("modified"),
                    F.col("pfw_role").alias("person_role"),
                    F.col("p_id").alias("person_id"),
                    F.col("p_name").alias("person_name"),
                    F.col("g_name").alias("genre_name")))


def person_branch(person_film_work: DataFrame, person: DataFrame) -> DataFrame:
    """A-2..A-5 per film: distinct actors and writers sorted by id, director.

    The person side of a link comes from the person table, as in the
    fan-out (an orphan link contributes a person with NULL id and name).
    ``collect_set`` and ``max`` aggregate partially before the shuffle, so a
    film with very many links is combined map-side first.
    """
    links = person_film_work.select("film_work_id", "person_id", "role")
    people = person.select(F.col("id").alias("pid"), F.col("full_name").alias("pname"))
    joined = links.join(people, links.person_id == people.pid, "left")
    ref = person_ref(F.col("pid"), F.col("pname"))
    return (joined.groupBy("film_work_id").agg(
        sorted_refs(F.collect_set(when_role(F.col("role"), ROLE_ACTOR, ref))).alias("actors"),
        sorted_refs(F.collect_set(when_role(F.col("role"), ROLE_WRITER, ref))).alias("writers"),
        # D-1/D-2 fixed: the director is a person's name; with several, the
        # greatest name, so the result does not depend on row order.
        F.max(when_role(F.col("role"), ROLE_DIRECTOR, F.col("pname"))).alias("director"),
    ))


def genre_branch(genre_film_work: DataFrame, genre: DataFrame) -> DataFrame:
    """A-6 per film: one genre, deterministically the least name (D-3)."""
    links = genre_film_work.select("film_work_id", "genre_id")
    names = genre.select(F.col("id").alias("gid"), F.col("name").alias("gname"))
    return (links.join(names, links.genre_id == names.gid, "left")
            .groupBy("film_work_id").agg(F.min("gname").alias("genre")))


def film_rows(tables: FilmTables, ids: DataFrame | None = None,
              limit: int | None = None) -> DataFrame:
    """A-1: one row per film with both branches attached (arrays native)."""
    t = _restricted(tables, ids, limit)
    fw = t.film_work
    people = person_branch(t.person_film_work, t.person)
    genres = genre_branch(t.genre_film_work, t.genre)
    return (fw
            .join(people, fw.id == people.film_work_id, "left").drop("film_work_id")
            .join(genres, fw.id == genres.film_work_id, "left").drop("film_work_id"))


def build_documents(tables: FilmTables, ids: DataFrame | None = None,
                    limit: int | None = None) -> DataFrame:
    """A-1..A-6, F-1..F-4, P-9: the document of each film (strict schema).

    ``ids`` (a frame with column ``id``) restricts to affected films;
    ``None`` is the full load, which includes films with a NULL
    ``modified`` (D-12). Films without links get empty lists, an empty
    director and a NULL genre (D-15).
    """
    rows = film_rows(tables, ids, limit)
    actors = or_empty_list(refs_as_string_ids(F.col("actors")))
    writers = or_empty_list(refs_as_string_ids(F.col("writers")))
    return rows.select(
        F.col("id").cast("string").alias("id"),
        F.col("rating").cast("double").alias("imdb_rating"),
        F.col("genre").cast("string").alias("genre"),
        F.col("title"), F.col("description"),
        or_empty_text(F.col("director")).alias("director"),
        or_empty_text(names_text(F.col("actors"))).alias("actors_names"),
        or_empty_text(names_text(F.col("writers"))).alias("writers_names"),
        actors.alias("actors"), writers.alias("writers"),
    )
