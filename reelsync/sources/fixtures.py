"""Film-domain views over the driver's tables.

The mapping (fixed values, see FIXTURES.md section 5):
  film_work        <- orders: id o_orderkey, title o_orderpriority,
                      description and type o_orderstatus, rating o_totalprice,
                      created = modified = o_orderdate
  person           <- supplier, modified = latest events.ts of that user
  person_film_work <- lineitem, distinct (l_suppkey, l_orderkey, role);
                      l_returnflag A = actor, R = writer, N = director
  genre            <- lineitem join part by p_type, modified = max(l_shipdate)
  genre_film_work  <- lineitem join part, distinct (p_type, l_orderkey)
  person changes   <- events: id user_id, modified ts, tie-break event_id

Keys keep their native (integer) types; operators do not care, and the copy
job casts them to the target's string keys.

Link rows are dealt by film before they are grouped, so that what follows by
film (a document's branches, the film-keyed layout) needs no shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ROLE_ACTOR, ROLE_DIRECTOR, ROLE_WRITER
from .film import FilmTables
from .tables import read_table


def _role(flag: F.Column) -> F.Column:
    return (F.when(flag == "A", F.lit(ROLE_ACTOR))
            .when(flag == "R", F.lit(ROLE_WRITER))
            .when(flag == "N", F.lit(ROLE_DIRECTOR)))


def film_work_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """film_work as the copy source holds it (source column names, an extra
    column the copy must drop)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("description"),
        F.to_date("o_orderdate").alias("creation_date"),
        F.col("o_totalprice").alias("rating"),
        F.col("o_orderstatus").alias("type"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_custkey").alias("custkey"),
    )


def person_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    seen = (read_table(spark, sf_dir, "events")
            .groupBy("user_id")
            .agg(F.min("ts").alias("created_at"), F.max("ts").alias("updated_at")))
    return (s.join(seen, s.s_suppkey == seen.user_id, "left")
            .select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("full_name"),
                    "created_at", "updated_at", F.col("s_nationkey").alias("nationkey")))


def person_film_work_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    links = (li.select(F.col("l_suppkey").alias("person_id"),
                       F.col("l_orderkey").alias("film_work_id"),
                       _role(F.col("l_returnflag")).alias("role"), "l_shipdate")
             .repartition("film_work_id").groupBy("person_id", "film_work_id", "role")
             .agg(F.min("l_shipdate").alias("created_at")))
    return links.select(
        F.concat_ws("/", "film_work_id", "person_id", "role").alias("id"),
        "person_id", "film_work_id", "role", "created_at")


def _typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey, "inner")


def genre_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a part's lines first: the join meets one row per part, not every line
    sold = (read_table(spark, sf_dir, "lineitem").groupBy("l_partkey")
            .agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")))
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (sold.join(parts, sold.l_partkey == parts.p_partkey, "inner")
            .groupBy("p_type")
            .agg(F.min("first").alias("created_at"), F.max("last").alias("updated_at"))
            .select(F.col("p_type").alias("id"), F.col("p_type").alias("name"),
                    F.lit(None).cast("string").alias("description"),
                    "created_at", "updated_at"))


def genre_film_work_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = (_typed_lines(spark, sf_dir)
             .select(F.col("p_type").alias("genre_id"), F.col("l_orderkey").alias("film_work_id"), "l_shipdate")
             .repartition("film_work_id").groupBy("genre_id", "film_work_id")
             .agg(F.min("l_shipdate").alias("created_at")))
    return links.select(F.concat_ws("/", "film_work_id", "genre_id").alias("id"),
                        "genre_id", "film_work_id", "created_at")


# The views whose rows come dealt by film.
DEALT = ("person_film_work", "genre_film_work")

SOURCES = {
    "film_work": film_work_source,
    "genre": genre_source,
    "genre_film_work": genre_film_work_source,
    "person": person_source,
    "person_film_work": person_film_work_source,
}


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables as the copy job's source holds them."""
    return {name: build(spark, sf_dir) for name, build in SOURCES.items()}


def _as_target(df: DataFrame) -> DataFrame:
    cols = [F.col(c).alias({"created_at": "created", "updated_at": "modified"}.get(c, c))
            for c in df.columns]
    return df.select(*cols)


def film_tables(spark: SparkSession, sf_dir: str) -> FilmTables:
    """The five relational tables, target column names, native key types."""
    return FilmTables(
        film_work=_as_target(film_work_source(spark, sf_dir).drop("custkey")),
        genre=_as_target(genre_source(spark, sf_dir)),
        genre_film_work=_as_target(genre_film_work_source(spark, sf_dir)),
        person=_as_target(person_source(spark, sf_dir).drop("nationkey")),
        person_film_work=_as_target(person_film_work_source(spark, sf_dir)),
    )


def person_changes(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The person change feed (batch or stream): one row per change event."""
    ev = events if events is not None else read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("id"), F.col("ts").alias("modified"),
                     "event_id", "event_type", "value")


def event_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as person links: their users and half their numbers as
    films. Many point at no person or film, which the link views never do."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("id"), F.col("user_id").alias("person_id"),
                     F.floor(F.col("event_id") / 2).cast("long").alias("film_work_id"),
                     F.col("event_type").alias("role"), F.col("ts").alias("created"))
