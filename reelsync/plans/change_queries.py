"""Queries over change detection and positions (P-4..P-7, J-5, J-6, J-8, O-1..O-4,
U-1, U-2, A-10, S-9, F-7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as C
from ..operators import state as S
from ..operators.counts import counted, rows_of
from ..operators.documents import enrich_fanout
from ..session import shared_path
from ..sources.fixtures import film_tables
from ..sources.link_index import LinkIndex
from . import oracle_views as V
from .registry import register

# Fixed parameters of the registered queries: the position each entity was
# last processed up to, and the size of a bounded catch-up batch.
FILM_POSITION = dt.datetime(2001, 6, 1)
PERSON_POSITION = dt.datetime(2024, 1, 30, 20, 0)
GENRE_POSITION = dt.datetime(2001, 6, 1)
CATCH_UP_BATCH = 100
FIRST_N_FILMS = 100

FILM_POS_SQL = "TIMESTAMP '2001-06-01 00:00:00'"
PERSON_POS_SQL = "TIMESTAMP '2024-01-30 20:00:00'"
GENRE_POS_SQL = "TIMESTAMP '2001-06-01 00:00:00'"

ALL_VIEWS = ("film_work", "person", "person_film_work", "genre", "genre_film_work")


def _changed(spark: SparkSession, sf_dir: str) -> tuple:
    t = film_tables(spark, sf_dir)
    changed = {
        "film_work": C.changed_since(t.film_work, FILM_POSITION),
        "person": C.changed_since(t.person, PERSON_POSITION),
        "genre": C.changed_since(t.genre, GENRE_POSITION),
    }
    return t, changed


@register("changed_films", V.with_views("film_work") + f"""
SELECT id, modified FROM film_work WHERE modified > {FILM_POS_SQL}""")
def changed_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-4: films modified after their position."""
    return C.changed_since(film_tables(spark, sf_dir).film_work, FILM_POSITION)


@register("changed_persons", V.with_views("person") + f"""
SELECT id, modified FROM person WHERE modified > {PERSON_POS_SQL}""")
def changed_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-4: persons modified after their position (NULL modified never)."""
    return C.changed_since(film_tables(spark, sf_dir).person, PERSON_POSITION)


@register("changed_genres", V.with_views("genre") + f"""
SELECT id, modified FROM genre WHERE modified > {GENRE_POS_SQL}""")
def changed_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-4: genres modified after their position."""
    return C.changed_since(film_tables(spark, sf_dir).genre, GENRE_POSITION)


CHANGED_BATCH_SQL = V.with_views("film_work") + f"""
SELECT id, modified FROM film_work WHERE modified > {FILM_POS_SQL}
ORDER BY modified, id LIMIT {CATCH_UP_BATCH}"""


@register("changed_batch", CHANGED_BATCH_SQL)
def changed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-1: the oldest changes first, a bounded batch, ties broken by id."""
    return C.changed_since(film_tables(spark, sf_dir).film_work, FILM_POSITION,
                           limit=CATCH_UP_BATCH)


@register("exclude_processed", V.with_views("film_work", extra=[f"""batch AS (
  SELECT id FROM film_work WHERE modified > {FILM_POS_SQL}
  ORDER BY modified, id LIMIT {CATCH_UP_BATCH})"""]) + f"""
SELECT c.id, c.modified FROM film_work c
WHERE c.modified > {FILM_POS_SQL} AND NOT EXISTS (SELECT 1 FROM batch b WHERE b.id = c.id)""")
def exclude_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-6 / J-6 / U-2: changes left after the first catch-up batch was handled."""
    films = film_tables(spark, sf_dir).film_work
    processed = C.accumulate_processed(
        None, C.changed_since(films, FILM_POSITION, limit=CATCH_UP_BATCH))
    return C.exclude_processed(C.changed_since(films, FILM_POSITION), processed)


FILMS_BY_PERSON_SQL = V.with_views("film_work", "person", "person_film_work") + f"""
SELECT fw.id FROM film_work fw
WHERE EXISTS (SELECT 1 FROM person_film_work pfw JOIN person p ON p.id = pfw.person_id
              WHERE pfw.film_work_id = fw.id AND p.modified > {PERSON_POS_SQL})"""


@register("films_by_person", FILMS_BY_PERSON_SQL)
def films_by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-5: films linked to persons changed after the position."""
    t, changed = _changed(spark, sf_dir)
    return C.films_by_entity(t, changed["person"], "person")


@register("films_by_person_indexed", FILMS_BY_PERSON_SQL)
def films_by_person_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-5: the same through the link index, of which only the places of the
    changed persons are read."""
    t, changed = _changed(spark, sf_dir)
    index = LinkIndex(shared_path(spark, "link_index", unique=True))
    index.build(t)
    return C.films_by_entity(t, changed["person"], "person", index)


FILMS_BY_GENRE_SQL = V.with_views("film_work", "genre", "genre_film_work") + f"""
SELECT fw.id FROM film_work fw
WHERE EXISTS (SELECT 1 FROM genre_film_work gfw JOIN genre g ON g.id = gfw.genre_id
              WHERE gfw.film_work_id = fw.id AND g.modified > {GENRE_POS_SQL})"""


@register("films_by_genre", FILMS_BY_GENRE_SQL)
def films_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-5: films linked to genres changed after the position."""
    t, changed = _changed(spark, sf_dir)
    return C.films_by_entity(t, changed["genre"], "genre")


AFFECTED_CTE = f"""affected AS (
  SELECT fw.id FROM film_work fw
  WHERE fw.modified > {FILM_POS_SQL}
     OR EXISTS (SELECT 1 FROM person_film_work pfw JOIN person p ON p.id = pfw.person_id
                WHERE pfw.film_work_id = fw.id AND p.modified > {PERSON_POS_SQL})
     OR EXISTS (SELECT 1 FROM genre_film_work gfw JOIN genre g ON g.id = gfw.genre_id
                WHERE gfw.film_work_id = fw.id AND g.modified > {GENRE_POS_SQL}))"""


@register("affected_films", V.with_views(*ALL_VIEWS, extra=[AFFECTED_CTE]) + "SELECT id FROM affected")
def affected_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U-1 / O-4: films touched by any entity change, each once."""
    t, changed = _changed(spark, sf_dir)
    return C.affected_films(t, changed)


ENRICH_FOR_IDS_SQL = V.with_views(*ALL_VIEWS, extra=[AFFECTED_CTE, V.FANOUT]) + """
SELECT * FROM fan WHERE id IN (SELECT id FROM affected)"""


@register("enrich_for_ids", ENRICH_FOR_IDS_SQL)
def enrich_for_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-7 / P-10 / J-8: enrichment rows restricted to the affected films."""
    t, changed = _changed(spark, sf_dir)
    return enrich_fanout(t, ids=C.affected_films(t, changed))


ENRICH_FIRST_N_SQL = V.with_views(*ALL_VIEWS, extra=[
    f"first_n AS (SELECT id FROM film_work ORDER BY id LIMIT {FIRST_N_FILMS})", V.FANOUT]) + """
SELECT * FROM fan WHERE id IN (SELECT id FROM first_n)"""


@register("enrich_first_n", ENRICH_FIRST_N_SQL)
def enrich_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-3: the limit applies to film ids before the joins, never to join rows."""
    return enrich_fanout(film_tables(spark, sf_dir), limit=FIRST_N_FILMS)


HIGH_WATER_SQL = V.with_views("film_work", "person", "genre") + """
SELECT 'genre' AS entity, max(modified) AS position, CAST(1 AS BIGINT) AS pass_id FROM genre
UNION ALL SELECT 'person', max(modified), 1 FROM person
UNION ALL SELECT 'film_work', max(modified), 1 FROM film_work"""


@register("high_water", HIGH_WATER_SQL)
def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-9 / A-10 / F-7: positions after a first pass over all entities,
    merged over the never-run state (NULL positions, pass 0)."""
    t = film_tables(spark, sf_dir)
    never = S.positions_of(
        spark.createDataFrame([(e,) for e in C.ENTITIES], "entity string")
        .withColumn("position", F.lit(None).cast("timestamp_ntz")), 0)
    first = S.positions_of(C.current_highs(t, C.ENTITIES), 1)
    return S.merge_positions(never, first)


STATE_JSON_SQL = V.with_views("film_work", "person", "genre") + "\nUNION ALL ".join(
    f"SELECT '{e}' AS entity, strftime(max(modified), '%Y-%m-%dT%H:%M:%S.%f') AS iso, "
    f"max(modified) AS position FROM {e}" for e in ("film_work", "person", "genre"))


@register("state_json", STATE_JSON_SQL)
def state_json_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-5 / F-6: the positions after a pass as one JSON text of ISO times, and
    read back from it."""
    highs = S.positions_of(C.current_highs(film_tables(spark, sf_dir), C.ENTITIES), 1)
    state = S.state_json(S.merge_positions(S.empty_positions(spark), highs))
    texts = state.select(F.explode(F.from_json("state", S.STATE_JSON_SCHEMA)).alias("entity", "iso"))
    return texts.join(S.positions_from_json(state).drop("pass_id"), "entity")


BATCH_COUNTS_SQL = V.with_views("film_work", "person", "genre") + f"""
SELECT 'film_work' AS entity, count(*) AS rows FROM film_work WHERE modified > {FILM_POS_SQL}
UNION ALL SELECT 'person', count(*) FROM person WHERE modified > {PERSON_POS_SQL}
UNION ALL SELECT 'genre', count(*) FROM genre WHERE modified > {GENRE_POS_SQL}"""


@register("batch_counts", BATCH_COUNTS_SQL)
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-9: rows of each entity's batch, counted while the batch is processed."""
    counts = []
    for entity, changed in _changed(spark, sf_dir)[1].items():
        batch, seen = counted(changed, entity)
        batch.write.format("noop").mode("overwrite").save()
        counts.append((entity, rows_of(seen)))
    return spark.createDataFrame(counts, "entity string, rows long")


ZONED_SQL = V.with_views("film_work", "person", "genre") + "\nUNION ALL ".join(
    f"SELECT '{e}' AS entity, max(modified) AS position, strftime(max(modified) + INTERVAL 3 HOUR, "
    f"'%Y-%m-%dT%H:%M:%S.%f') AS local, max(modified) AS back FROM {e}" for e in ("film_work", "person", "genre"))


@register("zoned_positions", ZONED_SQL)
def zoned_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-8: the positions after a pass on the clock of a fixed zone, and read
    back from those texts as the same instants."""
    highs = S.positions_of(C.current_highs(film_tables(spark, sf_dir), C.ENTITIES), 1)
    zoned = S.to_zone(highs).select("entity", "position", "local")
    back = S.from_zone(zoned.select("entity", "local")).withColumnRenamed("position", "back")
    return zoned.join(back, "entity")
