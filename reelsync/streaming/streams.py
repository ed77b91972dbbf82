"""Structured Streaming versions of the passes (R-1..R-6).

The reference polls every second and remembers a position in a key/value
store. Here a change feed is a streaming source, the position is the
query's checkpoint (a restart resumes after the last committed micro-batch,
R-3), and each micro-batch runs the batch plan inside ``foreachBatch``. A
batch replayed after a failure upserts the same rows again, which changes
nothing (R-5), so the sink is effectively exactly-once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import affected_films, position_literal
from ..operators.documents import build_documents
from ..operators.sinks import upsert
from ..schemas import DOCUMENT
from ..session import checkpoint_frame
from ..sources.film import FilmTables
from ..sources.link_index import LinkIndex
from .batch_counts import BatchCounts


def _trigger(writer, trigger: dict | None):
    """``{"availableNow": True}`` for a scheduled catch-up, or
    ``{"processingTime": "1 second"}`` for the reference's one-second poll (R-1)."""
    return writer.trigger(**(trigger or {"availableNow": True}))


def after_position(changes: DataFrame, position: dt.datetime | None,
                   look_back: dt.timedelta | None = None,
                   ts_col: str = "modified") -> DataFrame:
    """Changes after a saved position, with an optional look-back for rows
    whose timestamp was set earlier than it (harmless: the upsert is keyed)."""
    if position is None:
        return changes
    if look_back is not None:
        position = position - look_back
    return changes.where(F.col(ts_col) > position_literal(position, changes.schema[ts_col].dataType))


def upsert_stream(changes: DataFrame, path: str, checkpoint: str, key: list[str],
                  version_cols: list[str] | None = None,
                  trigger: dict | None = None, counts: BatchCounts | None = None) -> StreamingQuery:
    """R-1 / R-3 / R-4 / R-5: keep the latest row per key of a change feed.
    Within a micro-batch the latest change per key wins (R-4); across
    batches the versioned upsert decides. ``counts`` keeps the rows of each
    micro-batch (A-9)."""
    if counts is not None:
        changes = counts.observe(changes)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        upsert(batch, path, key, version_cols)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    query = _trigger(writer, trigger).start()
    if counts is not None:
        counts.follow(query)
    return query


def affected_documents_stream(changes: dict[str, DataFrame],
                              open_tables: Callable[[], FilmTables], path: str, checkpoint: str, trigger: dict | None = None,
                              on_batch: Callable[[int, DataFrame], None] | None = None,
                              index: LinkIndex | None = None, repeats_within: str | None = None
                              ) -> StreamingQuery:
    """R-6: entity change feeds fan out to films, whose documents are rebuilt
    and upserted. ``changes`` maps an entity (film_work, person, genre) to a
    streaming frame with an ``id`` column. The feeds are unioned into one
    query so a single writer owns the document table. ``open_tables`` is called
    in every micro-batch: a frame keeps the file list it was opened with, so a
    link added later would stay unseen. With an ``index`` of the links, those of
    unchanged entities are not read.

    ``repeats_within`` (a delay such as ``"1 hour"``) also drops a change that an
    earlier micro-batch has had (R-4): the same entity, id and ``modified``,
    arriving again within that delay, rebuilds nothing. The state store holds the
    changes of that delay alone; the watermark takes the older ones out. A change
    without ``modified`` is never a repeat.
    """
    timed = [F.col("modified").cast("timestamp").alias("modified")] if repeats_within else []
    tagged = [df.select(F.lit(entity).alias("entity"), F.col("id").cast("string").alias("id"), *timed)
              for entity, df in changes.items()]
    feed = tagged[0]
    for t in tagged[1:]:
        feed = feed.unionByName(t)
    if repeats_within:
        # NULLs would be one key: each undated change gets a value of its own
        feed = (feed.withColumn("__change", F.coalesce(F.col("modified").cast("string"), F.uuid()))
                .withWatermark("modified", repeats_within)
                .dropDuplicatesWithinWatermark(["entity", "id", "__change"]))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        ids = batch.dropDuplicates(["entity", "id"])    # R-4: each id once per batch
        # Entities present in this batch (at most three names on the driver);
        # the others do not touch their link tables.
        present = [r["entity"] for r in ids.select("entity").distinct().collect()]
        if not present:
            return
        tables = open_tables()
        changed = {e: ids.where(F.col("entity") == e)
                   .select(F.col("id").cast(tables.as_dict()[e].schema["id"].dataType).alias("id"))
                   for e in present}
        films = checkpoint_frame(affected_films(tables, changed, index))
        docs = build_documents(tables, films)
        upsert(docs, path, ["id"], schema=DOCUMENT, assume_unique=True)
        if on_batch is not None:
            on_batch(epoch_id, films)

    writer = feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query and surface its failure, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query
