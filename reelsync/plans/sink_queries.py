"""Queries over sinks, the copy job and quality checks (S-3..S-5, S-7, P-1..P-3,
J-7, A-7, A-8, Q-1..Q-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import position_literal
from ..operators.copy import (coerce, coerce_or_reject, copy_table, copy_tables, project_source, typed_rows,
                              unequal_rows)
from ..operators.dedupe import insert_if_absent
from ..operators.documents import build_documents
from ..operators.quality import constraint_report, orphan_report, prune_links
from ..operators.sinks import (bulk_records, current_version, latest_per_key, merge_latest, read_current, rebucket,
                               upsert)
from ..session import shared_path
from ..sources.fixtures import event_links, film_tables, person_changes, source_tables
from ..sources.tables import read_table
from .change_queries import PERSON_POSITION
from . import oracle_views as V
from .registry import register

ALL_VIEWS = ("film_work", "person", "person_film_work", "genre", "genre_film_work")
# Fixed value: the name of the document index.
INDEX = "movies"

# Fixed parameters: the two unique keys of the insert-if-absent queries.
LINE_ID_KEY = ["l_orderkey", "l_linenumber"]
LINE_NATURAL_KEY = ["l_orderkey", "l_suppkey", "l_returnflag"]
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                "l_shipdate"]


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as ``timestamp_ntz`` (session zone UTC) for comparison
    with engines whose timestamps carry no zone."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


SCAN_PROJECT_FILM_SQL = """
SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS description,
       CAST(o_orderdate AS DATE) AS creation_date, o_totalprice AS rating,
       o_orderstatus AS type, o_orderdate AS created, o_orderdate AS modified
FROM orders"""


@register("scan_project_film", SCAN_PROJECT_FILM_SQL)
def scan_project_film(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1 / P-1 / P-2: the film source scanned, projected to its declared
    columns (the extra one dropped) and renamed to the target names."""
    return project_source(source_tables(spark, sf_dir)["film_work"], "film_work")


COPY_FILM_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, o_orderstatus AS description,
       CAST(o_orderdate AS DATE) AS creation_date, o_totalprice AS rating,
       o_orderstatus AS type, o_orderdate AS created, o_orderdate AS modified
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderkey
  ORDER BY o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE), o_totalprice,
           o_orderstatus, o_orderdate, o_orderdate) = 1"""


@register("copy_film", COPY_FILM_SQL)
def copy_film(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3 / P-1..P-3: film_work copied into an empty target."""
    return ntz(copy_table("film_work", source_tables(spark, sf_dir)["film_work"]))


COPY_PERSON_SQL = V.with_views("person") + """
SELECT CAST(id AS VARCHAR) AS id, full_name, created, modified FROM person"""


@register("copy_person", COPY_PERSON_SQL)
def copy_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3 / P-1..P-3: person copied into an empty target."""
    return ntz(copy_table("person", source_tables(spark, sf_dir)["person"]))


# Fixed parameter: lines shipped before this day are in the target already.
TARGET_BEFORE = "1997-01-01"

INSERT_IF_ABSENT_SQL = f"""
SELECT * FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem t
                  WHERE t.l_shipdate < TIMESTAMP '{TARGET_BEFORE} 00:00:00'
                    AND t.l_orderkey = l.l_orderkey AND t.l_linenumber = l.l_linenumber)
QUALIFY row_number() OVER (PARTITION BY {', '.join(LINE_ID_KEY)}
                           ORDER BY {', '.join(LINE_COLUMNS)}) = 1"""


@register("insert_if_absent", INSERT_IF_ABSENT_SQL)
def insert_if_absent_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-4 / J-7 / A-8: lineitem rows inserted under the key (order, line
    number) into a target that holds the earlier lines; among the rest an
    earlier row in all-column order wins."""
    rows = read_table(spark, sf_dir, "lineitem")
    held = F.lit(f"{TARGET_BEFORE} 00:00:00").cast("timestamp_ntz").cast(rows.schema["l_shipdate"].dataType)
    return insert_if_absent(rows, rows.where(F.col("l_shipdate") < held), [LINE_ID_KEY], LINE_COLUMNS)


def _two_key_rounds(rounds: int) -> str:
    """The greedy rule unrolled: in each round the rows that are first under
    both keys are taken, and rows that share a key with them go. Rows left
    after the last round are returned too, so that too few rounds show."""
    first = lambda key: f"min(rid) OVER (PARTITION BY {', '.join(key)})"
    same = lambda key: " AND ".join(f"w.{c} = r.{c}" for c in key)
    ctes = [f"r0 AS (SELECT *, row_number() OVER (ORDER BY {', '.join(LINE_COLUMNS)}) AS rid FROM lineitem)"]
    for i in range(rounds):
        ctes.append(f"""w{i} AS (SELECT * FROM r{i}
  QUALIFY rid = {first(LINE_ID_KEY)} AND rid = {first(LINE_NATURAL_KEY)})""")
        ctes.append(f"""r{i + 1} AS (SELECT r.* FROM r{i} r
  WHERE NOT EXISTS (SELECT 1 FROM w{i} w WHERE {same(LINE_ID_KEY)})
    AND NOT EXISTS (SELECT 1 FROM w{i} w WHERE {same(LINE_NATURAL_KEY)}))""")
    taken = [f"SELECT {', '.join(LINE_COLUMNS)} FROM {name}"
             for name in [*[f"w{i}" for i in range(rounds)], f"r{rounds}"]]
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(taken)


@register("insert_two_keys", _two_key_rounds(4))
def insert_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-8 / D-17: greedy keep-first under the id key *and* the natural key
    (order, supplier, return flag)."""
    rows = read_table(spark, sf_dir, "lineitem")
    return insert_if_absent(rows, None, [LINE_ID_KEY, LINE_NATURAL_KEY], LINE_COLUMNS)


def _repeated(table: str) -> str:
    """Source rows: the parents' every tenth id comes twice."""
    return "count(*) + count(*) FILTER (WHERE id % 10 = 0)" if table in ("film_work", "person") else "count(*)"


COUNT_PARITY_SQL = V.with_views(*ALL_VIEWS) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, {_repeated(t)} AS source_rows, count(DISTINCT id) AS target_rows, "
    f"{_repeated(t)} = count(DISTINCT id) AS match FROM {t}"
    for t in ALL_VIEWS)


@register("count_parity", COUNT_PARITY_SQL)
def count_parity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3 / A-7 / Q-1: the whole copy job into a fresh folder, then the rows
    of the sources and of the written tables compared. Some source ids come
    twice, so not every table matches."""
    sources = source_tables(spark, sf_dir)
    for table in ("film_work", "person"):
        df = sources[table]
        sources[table] = df.unionByName(df.where(F.col("id") % 10 == 0))
    return copy_tables(sources, shared_path(spark, "count_parity", unique=True))


COPY_LINKS_SQL = V.with_views("film_work", "person", extra=[V.EVENT_LINKS]) + """
SELECT CAST(l.id AS VARCHAR) AS id, CAST(l.person_id AS VARCHAR) AS person_id,
       CAST(l.film_work_id AS VARCHAR) AS film_work_id, l.role, l.created
FROM person_film_work l
WHERE EXISTS (SELECT 1 FROM person p WHERE p.id = l.person_id)
  AND EXISTS (SELECT 1 FROM film_work f WHERE f.id = l.film_work_id)
QUALIFY row_number() OVER (PARTITION BY l.person_id, l.film_work_id, l.role
                           ORDER BY CAST(l.id AS VARCHAR)) = 1"""


@register("copy_links", COPY_LINKS_SQL)
def copy_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3 / S-4 / D-18: parents and links copied twice into one folder; links
    without a parent are left out before keep-first, and the second copy adds
    nothing. Returns the written link table."""
    sources = {k: v for k, v in source_tables(spark, sf_dir).items() if k in ("film_work", "person")}
    sources["person_film_work"] = event_links(spark, sf_dir).withColumnRenamed("created", "created_at")
    root = shared_path(spark, "copy_links", unique=True)
    for _ in range(2):
        copy_tables(sources, root, on_orphans="drop", order_cols={"person_film_work": ["id"]})
    return ntz(spark.read.parquet(f"{root}/person_film_work"))


COPY_REJECT_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE '1.5' END AS rating,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS title
FROM orders WHERE o_orderkey % 7 = 0 OR o_orderstatus = 'P'"""


@register("copy_reject", COPY_REJECT_SQL)
def copy_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-3, reject path: rows that do not cast to the target's types or break
    its constraints, instead of failing the job."""
    films = project_source(source_tables(spark, sf_dir)["film_work"], "film_work")
    films = films.withColumns({
        "id": F.col("id").cast("string"),
        "rating": F.when(F.col("id") % 7 == 0, "n/a").otherwise("1.5"),
        "title": F.when(F.col("type") != "P", F.col("title"))})
    return coerce_or_reject(films, "film_work")[1].select("id", "rating", "title")


BROKEN_VIEWS = [
    "broken_film AS (SELECT CASE WHEN type <> 'P' THEN title END AS title FROM film_work)",
    """broken_person AS (
  SELECT CASE WHEN id % 3 = 0 THEN repeat(full_name, 20) ELSE full_name END AS full_name FROM person)"""]

CONSTRAINT_SQL = V.with_views(*ALL_VIEWS, extra=BROKEN_VIEWS) + """
SELECT 'film_work' AS table_name, 'id' AS column_name, 'not_null' AS rule,
       count(*) FILTER (WHERE id IS NULL) AS violations FROM film_work
UNION ALL SELECT 'film_work', 'title', 'not_null', count(*) FILTER (WHERE title IS NULL) FROM broken_film
UNION ALL SELECT 'film_work', 'type', 'not_null', count(*) FILTER (WHERE type IS NULL) FROM film_work
UNION ALL SELECT 'genre', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM genre
UNION ALL SELECT 'genre', 'name', 'not_null', count(*) FILTER (WHERE name IS NULL) FROM genre
UNION ALL SELECT 'genre_film_work', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM genre_film_work
UNION ALL SELECT 'person', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM person
UNION ALL SELECT 'person', 'full_name', 'max_length_250',
                 count(*) FILTER (WHERE length(full_name) > 250) FROM broken_person
UNION ALL SELECT 'person_film_work', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM person_film_work
UNION ALL SELECT 'person_film_work', 'role', 'max_length_250',
                 count(*) FILTER (WHERE length(role) > 250) FROM person_film_work"""


@register("constraint_report", CONSTRAINT_SQL)
def constraint_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-2: NOT NULL and length violations of the typed source tables, some of
    whose titles are taken away and some of whose names are lengthened."""
    typed = {name: coerce(project_source(df, name), name)
             for name, df in source_tables(spark, sf_dir).items()}
    film, person = typed["film_work"], typed["person"]
    typed["film_work"] = film.withColumn("title", F.when(F.col("type") != "P", F.col("title")))
    typed["person"] = person.withColumn("full_name", F.when(
        F.col("id").cast("long") % 3 == 0, F.repeat("full_name", F.lit(20))).otherwise(F.col("full_name")))
    return constraint_report(typed)


PARENTS_AND_EVENTS = V.with_views("film_work", "person", "genre", "genre_film_work", extra=[V.EVENT_LINKS])

ORPHAN_SQL = PARENTS_AND_EVENTS + """
SELECT 'genre_film_work' AS table_name, 'genre_id' AS column_name, 'genre' AS parent_table,
       count(*) AS orphans FROM genre_film_work l
WHERE l.genre_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM genre p WHERE p.id = l.genre_id)
UNION ALL SELECT 'genre_film_work', 'film_work_id', 'film_work', count(*) FROM genre_film_work l
WHERE l.film_work_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM film_work p WHERE p.id = l.film_work_id)
UNION ALL SELECT 'person_film_work', 'person_id', 'person', count(*) FROM person_film_work l
WHERE l.person_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM person p WHERE p.id = l.person_id)
UNION ALL SELECT 'person_film_work', 'film_work_id', 'film_work', count(*) FROM person_film_work l
WHERE l.film_work_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM film_work p WHERE p.id = l.film_work_id)"""


def _with_event_links(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return film_tables(spark, sf_dir).replace(person_film_work=event_links(spark, sf_dir)).as_dict()


@register("orphan_report", ORPHAN_SQL)
def orphan_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-3: dangling non-NULL foreign keys per link column; the person links
    are the events, many of whose users and films do not exist."""
    return orphan_report(_with_event_links(spark, sf_dir))


PRUNE_SQL = PARENTS_AND_EVENTS + """
SELECT 'genre_film_work' AS table_name, l.id FROM genre_film_work l
WHERE (l.genre_id IS NULL OR EXISTS (SELECT 1 FROM genre p WHERE p.id = l.genre_id))
  AND (l.film_work_id IS NULL OR EXISTS (SELECT 1 FROM film_work p WHERE p.id = l.film_work_id))
UNION ALL SELECT 'person_film_work', CAST(l.id AS VARCHAR) FROM person_film_work l
WHERE (l.person_id IS NULL OR EXISTS (SELECT 1 FROM person p WHERE p.id = l.person_id))
  AND (l.film_work_id IS NULL OR EXISTS (SELECT 1 FROM film_work p WHERE p.id = l.film_work_id))"""


@register("prune_links", PRUNE_SQL)
def prune_links_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-4: link rows that survive the cascade from their parents (links as in
    ``orphan_report``)."""
    pruned = prune_links(_with_event_links(spark, sf_dir))
    parts = [df.select(F.lit(name).alias("table_name"), F.col("id").cast("string").alias("id"))
             for name, df in sorted(pruned.items())]
    return parts[0].unionByName(parts[1])


DOCUMENT_UPSERT_SQL = """
SELECT user_id AS id, ts AS modified, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

PERSON_VERSION = ["modified", "event_id"]


@register("document_upsert", DOCUMENT_UPSERT_SQL)
def document_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-5: the person change feed up to the position is the stored state;
    the changes after it are upserted by id, the latest (ts, event_id) wins."""
    feed = person_changes(spark, sf_dir)
    ts = feed.schema["modified"].dataType
    pos = position_literal(PERSON_POSITION, ts)
    stored = latest_per_key(feed.where(F.col("modified") <= pos), ["id"], PERSON_VERSION)
    return merge_latest(stored, feed.where(F.col("modified") > pos), ["id"], PERSON_VERSION)


LAYERED_SQL = f"""WITH latest AS ({DOCUMENT_UPSERT_SQL})
SELECT 'layers' AS state, * FROM latest UNION ALL SELECT 'merged', * FROM latest"""


@register("layered_upsert", LAYERED_SQL)
def layered_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-5 / R-5: the person change feed upserted in four batches, out of order
    and one of them twice, each a layer over the first; the table as read through
    its layers, and as read after they were merged into more buckets."""
    feed, path = person_changes(spark, sf_dir), shared_path(spark, "layered_upsert", unique=True)
    for part in (2, 0, 3, 0, 1):
        upsert(feed.where(F.col("event_id") % 4 == part), path, ["id"], PERSON_VERSION, share=float("inf"))
    layered = current_version(spark, path)
    rebucket(spark, path, 48)
    parts = [read_current(spark, path, version=v).select(F.lit(state).alias("state"), "*")
             for state, v in (("layers", layered), ("merged", None))]
    return parts[0].unionByName(parts[1])


ALTERED_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderkey % 1000 = 7 THEN 'missing' ELSE 'altered' END AS kind
FROM orders WHERE o_orderkey % 1000 IN (7, 8)
UNION ALL SELECT 'new ' || CAST(o_orderkey AS VARCHAR), 'extra' FROM orders WHERE o_orderkey % 1000 = 7"""


@register("altered_rows", ALTERED_SQL)
def altered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-1 / D-20: a copy with as many rows as its source, some of which have
    another title or another id: totals agree, the checksums name the rows."""
    rows = typed_rows("film_work", source_tables(spark, sf_dir)["film_work"])
    number = F.col("id").cast("long") % 1000
    copy = rows.withColumns({"title": F.when(number == 8, F.concat("title", F.lit("?"))).otherwise(F.col("title")),
                             "id": F.when(number == 7, F.concat(F.lit("new "), "id")).otherwise(F.col("id"))})
    return unequal_rows("film_work", rows, copy)


def _json_refs(role: str) -> str:
    return f"""{role}s_json AS (
  SELECT id, to_json(list(struct_pack(id := CAST(person_id AS VARCHAR), name := person_name)
                          ORDER BY person_id, person_name)) AS {role}s
  FROM (SELECT DISTINCT id, person_id, person_name FROM fan WHERE person_role = '{role}') d
  GROUP BY id)"""


BULK_SQL = V.with_views(*ALL_VIEWS, extra=[V.FANOUT, V.role_lists(), _json_refs("actor"),
                                           _json_refs("writer")]) + f"""
SELECT CAST(fw.id AS VARCHAR) AS id,
  CAST(json_object('index', json_object('_index', '{INDEX}', '_id', CAST(fw.id AS VARCHAR))) AS VARCHAR)
    AS action,
  CAST(json_object('actors', coalesce(aj.actors, CAST('[]' AS JSON)),
                   'actors_names', coalesce(a.actors_names, ''),
                   'description', fw.description,
                   'director', coalesce(d.director, ''),
                   'genre', g.genre,
                   'id', CAST(fw.id AS VARCHAR),
                   'imdb_rating', fw.rating,
                   'title', fw.title,
                   'writers', coalesce(wj.writers, CAST('[]' AS JSON)),
                   'writers_names', coalesce(w.writers_names, '')) AS VARCHAR) AS source
FROM film_work fw
LEFT JOIN actors a ON a.id = fw.id
LEFT JOIN writers w ON w.id = fw.id
LEFT JOIN actors_json aj ON aj.id = fw.id
LEFT JOIN writers_json wj ON wj.id = fw.id
LEFT JOIN directors d ON d.id = fw.id
LEFT JOIN genres g ON g.id = fw.id"""


@register("bulk_records", BULK_SQL)
def bulk_records_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-7: every document as a bulk action line and a JSON source line."""
    return bulk_records(build_documents(film_tables(spark, sf_dir)), INDEX)
