"""The film-domain views as plain SQL, for the DuckDB oracle of each query.

Same mapping as ``reelsync.sources.fixtures`` (FIXTURES.md section 5),
written once and prepended as CTEs.
"""

from __future__ import annotations

FILM_WORK = """film_work AS (
  SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS description,
         CAST(o_orderdate AS DATE) AS creation_date, o_totalprice AS rating,
         o_orderstatus AS type, o_orderdate AS created, o_orderdate AS modified
  FROM orders)"""

PERSON = """person AS (
  SELECT s.s_suppkey AS id, s.s_name AS full_name, e.created, e.modified
  FROM supplier s
  LEFT JOIN (SELECT user_id, min(ts) AS created, max(ts) AS modified
             FROM events GROUP BY user_id) e ON e.user_id = s.s_suppkey)"""

PERSON_FILM_WORK = """person_film_work AS (
  SELECT CAST(film_work_id AS VARCHAR) || '/' || CAST(person_id AS VARCHAR) || '/' || role AS id,
         person_id, film_work_id, role, created
  FROM (SELECT l_suppkey AS person_id, l_orderkey AS film_work_id,
               CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'R' THEN 'writer'
                                 WHEN 'N' THEN 'director' END AS role,
               min(l_shipdate) AS created
        FROM lineitem GROUP BY 1, 2, 3) x)"""

GENRE = """genre AS (
  SELECT p_type AS id, p_type AS name, CAST(NULL AS VARCHAR) AS description,
         min(l_shipdate) AS created, max(l_shipdate) AS modified
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type)"""

GENRE_FILM_WORK = """genre_film_work AS (
  SELECT CAST(film_work_id AS VARCHAR) || '/' || genre_id AS id, genre_id, film_work_id, created
  FROM (SELECT p_type AS genre_id, l_orderkey AS film_work_id, min(l_shipdate) AS created
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) x)"""

# The events as person links (sources.fixtures.event_links).
EVENT_LINKS = """person_film_work AS (
  SELECT event_id AS id, user_id AS person_id, event_id // 2 AS film_work_id, event_type AS role, ts AS created
  FROM events)"""

ALL = {
    "film_work": FILM_WORK,
    "person": PERSON,
    "person_film_work": PERSON_FILM_WORK,
    "genre": GENRE,
    "genre_film_work": GENRE_FILM_WORK,
}

# Person rows per film and genre rows per film, each on its own; a film pairs
# all of the one with all of the other, and keeps one empty row where a side
# has none.
FANOUT = """film_people AS (
  SELECT links.film_work_id AS film, links.role AS person_role, people.id AS person_id,
         people.full_name AS person_name
  FROM person_film_work AS links LEFT JOIN person AS people ON links.person_id = people.id),
film_genres AS (
  SELECT links.film_work_id AS film, kinds.name AS genre_name
  FROM genre_film_work AS links LEFT JOIN genre AS kinds ON links.genre_id = kinds.id),
film_rows AS (
  SELECT film_work.*, film_genres.genre_name
  FROM film_work LEFT JOIN film_genres ON film_genres.film = film_work.id),
fan AS (
  SELECT film_rows.id, film_rows.title, film_rows.description, film_rows.rating, film_rows.type,
         film_rows.created, film_rows.modified, film_people.person_role, film_people.person_id,
         film_people.person_name, film_rows.genre_name
  FROM film_rows LEFT JOIN film_people ON film_people.film = film_rows.id)"""


def with_views(*names: str, extra: list[str] | None = None) -> str:
    parts = [ALL[n] for n in names] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"


def role_lists(fan: str = "fan") -> str:
    """Per film: distinct persons of each role as ``id:name`` text in id order,
    names joined by a bare comma, and the greatest director name."""
    def refs(role: str) -> str:
        return f"""{role}s AS (
  SELECT id,
         string_agg(CAST(person_id AS VARCHAR) || ':' || coalesce(person_name, ''), ';'
                    ORDER BY person_id, person_name) AS {role}s,
         string_agg(person_name, ',' ORDER BY person_id, person_name) AS {role}s_names
  FROM (SELECT DISTINCT id, person_id, person_name FROM {fan} WHERE person_role = '{role}') d
  GROUP BY id)"""
    return ",\n".join([
        refs("actor"), refs("writer"),
        f"""directors AS (
  SELECT id, max(person_name) AS director FROM {fan}
  WHERE person_role = 'director' GROUP BY id)""",
        f"""genres AS (SELECT id, min(genre_name) AS genre FROM {fan} GROUP BY id)""",
    ])
