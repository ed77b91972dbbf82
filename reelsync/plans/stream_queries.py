"""Queries that run a stream or a load pass to the end in a fresh folder under
the shared checkpoint root (R-1..R-6, R-2), then return what the sink holds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as C
from ..operators.changes import position_literal
from ..operators.documents import build_documents
from ..operators.sinks import ensure_target, parquet_upsert_sink, read_current, write_documents
from ..schemas import DOCUMENT
from ..session import shared_path
from ..sources.film import FilmTables
from ..sources.fixtures import DEALT, film_tables, person_changes
from ..sources.layout import bucketed
from ..sources.position_stream import position_stream
from ..sources.tables import stream_table
from ..streaming.batch_counts import BatchCounts
from ..streaming.streams import after_position, affected_documents_stream, run_to_end, upsert_stream
from ..operators.state import save_positions
from ..schemas import HIGH_WATER
from . import oracle_views as V
from .change_queries import (FILM_POS_SQL, FILM_POSITION, FILMS_BY_PERSON_SQL, GENRE_POS_SQL, GENRE_POSITION,
                             PERSON_POS_SQL, PERSON_POSITION)
from .document_queries import FILM_DOCUMENTS_SQL, documents_as_text
from .load import SyncPaths, catch_up, full_load, incremental_pass, remove_entities
from .registry import register
from .sink_queries import DOCUMENT_UPSERT_SQL, PERSON_VERSION


@register("stream_upsert", DOCUMENT_UPSERT_SQL)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-1, R-3..R-5: the person change feed as a file stream, upserted by id
    (latest ts, then event_id); equals ``document_upsert``."""
    base = shared_path(spark, "stream_upsert", unique=True)
    feed = person_changes(spark, sf_dir, events=stream_table(spark, sf_dir, "events"))
    run_to_end(upsert_stream(feed, f"{base}/table", f"{base}/checkpoint", ["id"], PERSON_VERSION))
    out = read_current(spark, f"{base}/table")
    if out is None:
        return person_changes(spark, sf_dir).where(F.lit(False))
    return out


@register("stream_batch_counts", "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS rows FROM events")
def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-9 in streams: the rows of each micro-batch of the person change feed,
    counted while it is upserted; running the stream again adds none."""
    base = shared_path(spark, "stream_batch_counts", unique=True)
    for _ in range(2):
        counts = BatchCounts(spark, f"{base}/counts")
        feed = person_changes(spark, sf_dir, events=stream_table(spark, sf_dir, "events"))
        run_to_end(upsert_stream(feed, f"{base}/table", f"{base}/checkpoint", ["id"], PERSON_VERSION, counts=counts))
        counts.close()
    return counts.read()


STREAM_POSITIONS_SQL = V.with_views("film_work", "person", "genre") + "\nUNION ALL ".join(
    f"SELECT '{e}' AS entity, CAST(id AS VARCHAR) AS id FROM {e} WHERE modified > {position}"
    for e, position in (("film_work", FILM_POS_SQL), ("person", PERSON_POS_SQL), ("genre", GENRE_POS_SQL)))


@register("stream_positions", STREAM_POSITIONS_SQL)
def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-1 / R-3 / P-4: the changes of every entity after its position, read as
    streams whose offset is a position, in two runs of one query: the first ends
    at a time between, the second goes on from the checkpoint. No change is read
    twice or left out."""
    base = shared_path(spark, "stream_positions", unique=True)
    tables = film_tables(spark, sf_dir).as_dict()
    bounds = {"film_work": (FILM_POSITION, FILM_POSITION + dt.timedelta(days=20)),
              "person": (PERSON_POSITION, PERSON_POSITION + dt.timedelta(hours=1)),
              "genre": (GENRE_POSITION, GENRE_POSITION + dt.timedelta(days=20))}
    for entity in bounds:
        tables[entity].select("id", "modified").write.parquet(f"{base}/{entity}")
    for ends in (True, False):
        feed = None
        for entity, (after, until) in bounds.items():
            options = {"after": after.isoformat(), **({"until": until.isoformat()} if ends else {})}
            one = position_stream(spark, f"{base}/{entity}", tables[entity].select("id", "modified").schema, **options)
            one = one.select(F.lit(entity).alias("entity"), F.col("id").cast("string").alias("id"))
            feed = one if feed is None else feed.unionByName(one)
        run_to_end(feed.writeStream.format("parquet").option("path", f"{base}/changes")
                   .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    return spark.read.schema("entity string, id string").parquet(f"{base}/changes")


STREAM_AFFECTED_SQL = ("SELECT d.* FROM (" + FILM_DOCUMENTS_SQL + ") d WHERE d.id IN (SELECT "
                       "CAST(f.id AS VARCHAR) FROM (" + FILMS_BY_PERSON_SQL + ") f)")


@register("stream_affected", STREAM_AFFECTED_SQL)
def stream_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-6: person changes after the position, streamed; each micro-batch
    opens the tables, fans out through the links and upserts the films'
    documents. Returns the documents written: those of ``films_by_person``."""
    base = shared_path(spark, "stream_affected", unique=True)
    feed = after_position(
        person_changes(spark, sf_dir, events=stream_table(spark, sf_dir, "events")),
        PERSON_POSITION)
    run_to_end(affected_documents_stream({"person": feed}, lambda: film_tables(spark, sf_dir),
                                         f"{base}/documents", f"{base}/checkpoint"))
    docs = read_current(spark, f"{base}/documents", DOCUMENT)
    return documents_as_text(docs if docs is not None else spark.createDataFrame([], DOCUMENT))


def older_tables(tables: FilmTables) -> FilmTables:
    """``tables`` as they were before the changes after the fixed positions."""
    def before(df: DataFrame, column: str, position: dt.datetime) -> DataFrame:
        changed = F.col("modified") > position_literal(position, df.schema["modified"].dataType)
        return df.withColumn(column, F.when(changed, F.concat(F.lit("old "), column)).otherwise(F.col(column)))

    return tables.replace(film_work=before(tables.film_work, "title", FILM_POSITION),
                          person=before(tables.person, "full_name", PERSON_POSITION),
                          genre=before(tables.genre, "name", GENRE_POSITION))


@register("write_documents", FILM_DOCUMENTS_SQL)
def write_documents_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-6 / S-8: a strict target created empty, then filled through the
    document writer and its sink; returns what the target holds."""
    path = shared_path(spark, "write_documents", unique=True)
    ensure_target(spark, path, DOCUMENT)
    write_documents(build_documents(film_tables(spark, sf_dir)), parquet_upsert_sink(path, schema=DOCUMENT))
    return documents_as_text(read_current(spark, path, DOCUMENT))


@register("incremental_documents", FILM_DOCUMENTS_SQL)
def incremental_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-2 / D-8..D-10 end to end: a full load of older tables, in which every
    row changed after its entity's position had another title or name; the
    positions saved as pass 1; then an incremental pass over the tables as
    they are. The stored documents must equal ``film_documents``, so every
    film that a change touches has to be found and rebuilt."""
    base = shared_path(spark, "incremental_documents", unique=True)
    paths = SyncPaths(f"{base}/documents", f"{base}/positions")
    with bucketed(film_tables(spark, sf_dir), DEALT) as tables:
        full_load(older_tables(tables), paths, pass_id=0)
        rows = [("film_work", FILM_POSITION, 1), ("person", PERSON_POSITION, 1),
                ("genre", GENRE_POSITION, 1)]
        save_positions(spark.createDataFrame(rows, HIGH_WATER), paths.positions)
        incremental_pass(tables, paths)
    return documents_as_text(read_current(spark, paths.documents, DOCUMENT))


@register("backlog_documents", FILM_DOCUMENTS_SQL)
def backlog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-1 / O-4: as ``incremental_documents``, but the changes since the
    positions are worked off in four passes (more where persons lag behind)."""
    base = shared_path(spark, "backlog_documents", unique=True)
    paths = SyncPaths(f"{base}/documents", f"{base}/positions")
    with bucketed(film_tables(spark, sf_dir), DEALT) as tables:
        full_load(older_tables(tables), paths, pass_id=0)
        rows = [("film_work", FILM_POSITION, 1), ("person", PERSON_POSITION, 1), ("genre", GENRE_POSITION, 1)]
        save_positions(spark.createDataFrame(rows, HIGH_WATER), paths.positions)
        pending = C.changed_since(tables.film_work, FILM_POSITION).count()
        catch_up(tables, paths, max_changes=max(100, -(-pending // 4)))
    return documents_as_text(read_current(spark, paths.documents, DOCUMENT))


REMOVED_SQL = (FILM_DOCUMENTS_SQL
               .replace("FROM orders)", "FROM orders WHERE o_orderkey % 50 <> 7)")
               .replace("FROM lineitem GROUP BY 1, 2, 3", "FROM lineitem WHERE l_suppkey % 10 <> 3 GROUP BY 1, 2, 3"))


@register("removed_documents", REMOVED_SQL)
def removed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-4 end to end: every film loaded, then a tenth of the persons and a
    fiftieth of the films removed; the stored documents without them."""
    base = shared_path(spark, "removed_documents", unique=True)
    paths = SyncPaths(f"{base}/documents", f"{base}/positions")
    with bucketed(film_tables(spark, sf_dir), DEALT) as tables:
        full_load(tables, paths)
        remove_entities(tables, {"person": tables.person.where(F.col("id") % 10 == 3),
                                 "film_work": tables.film_work.where(F.col("id") % 50 == 7)}, paths)
    return documents_as_text(read_current(spark, paths.documents, DOCUMENT))
