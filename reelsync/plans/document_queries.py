"""Queries over enrichment and documents (J-1..J-8, A-1..A-6, F-1..F-4, P-7..P-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.docs import refs_text
from ..operators.documents import build_documents, enrich_fanout, genre_branch, person_branch
from ..sources.fixtures import film_tables
from . import oracle_views as V
from .registry import register

ALL_VIEWS = ("film_work", "person", "person_film_work", "genre", "genre_film_work")


def documents_as_text(docs: DataFrame) -> DataFrame:
    """Nested lists as ``id:name`` text, for comparison with SQL engines."""
    return docs.withColumns({"actors": refs_text(F.col("actors")),
                             "writers": refs_text(F.col("writers"))})


FILM_DOCUMENTS_SQL = V.with_views(*ALL_VIEWS, extra=[V.FANOUT, V.role_lists()]) + """
SELECT CAST(fw.id AS VARCHAR) AS id, fw.rating AS imdb_rating, g.genre, fw.title,
       fw.description, coalesce(d.director, '') AS director,
       coalesce(a.actors_names, '') AS actors_names,
       coalesce(w.writers_names, '') AS writers_names,
       coalesce(a.actors, '') AS actors, coalesce(w.writers, '') AS writers
FROM film_work fw
LEFT JOIN actors a ON a.id = fw.id
LEFT JOIN writers w ON w.id = fw.id
LEFT JOIN directors d ON d.id = fw.id
LEFT JOIN genres g ON g.id = fw.id
"""


@register("film_documents", FILM_DOCUMENTS_SQL)
def film_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: full load of every film as a document (A-1, P-5, P-9, R-2)."""
    return documents_as_text(build_documents(film_tables(spark, sf_dir)))


ENRICH_FANOUT_SQL = V.with_views(*ALL_VIEWS, extra=[V.FANOUT]) + "SELECT * FROM fan"


@register("enrich_fanout", ENRICH_FANOUT_SQL)
def enrich_fanout_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2, P-8, J-1..J-4: the 11-column enrichment rows of every film."""
    return enrich_fanout(film_tables(spark, sf_dir))


def _role_query(role: str) -> tuple[str, str]:
    sql = V.with_views(*ALL_VIEWS, extra=[V.FANOUT, V.role_lists()]) + f"""
SELECT CAST(id AS VARCHAR) AS id, {role}s, coalesce({role}s_names, '') AS {role}s_names
FROM {role}s"""
    return f"film_{role}s", sql


def _film_role_lists(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    t = film_tables(spark, sf_dir)
    rows = person_branch(t.person_film_work, t.person).withColumnRenamed("film_work_id", "id")
    refs = F.col(f"{role}s")
    return (rows.where(F.size(refs) > 0)
            .select(F.col("id").cast("string").alias("id"),
                    refs_text(refs).alias(f"{role}s"),
                    F.array_join(F.transform(refs, lambda p: p["name"]), ",")
                    .alias(f"{role}s_names")))


@register(*_role_query("actor"))
def film_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-2, A-4, F-1, F-4: distinct actors per film (films with any)."""
    return _film_role_lists(spark, sf_dir, "actor")


@register(*_role_query("writer"))
def film_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-3, A-4, F-1, F-4: distinct writers per film (films with any)."""
    return _film_role_lists(spark, sf_dir, "writer")


FILM_DIRECTOR_SQL = V.with_views(*ALL_VIEWS, extra=[V.FANOUT, V.role_lists()]) + """
SELECT CAST(id AS VARCHAR) AS id, director FROM directors"""


@register("film_director", FILM_DIRECTOR_SQL)
def film_director(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-5: the director of each film that has a director link."""
    t = film_tables(spark, sf_dir)
    rows = person_branch(t.person_film_work, t.person).withColumnRenamed("film_work_id", "id")
    return (rows.where(F.col("director").isNotNull())
            .select(F.col("id").cast("string").alias("id"), "director"))


FILM_GENRE_SQL = V.with_views(*ALL_VIEWS, extra=[V.FANOUT, V.role_lists()]) + """
SELECT CAST(id AS VARCHAR) AS id, genre FROM genres WHERE genre IS NOT NULL"""


@register("film_genre", FILM_GENRE_SQL)
def film_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-6: one genre per film that has a genre link."""
    t = film_tables(spark, sf_dir)
    rows = genre_branch(t.genre_film_work, t.genre).withColumnRenamed("film_work_id", "id")
    return (rows.where(F.col("genre").isNotNull())
            .select(F.col("id").cast("string").alias("id"), "genre"))
