"""Load plans: the first full load and the incremental pass (R-2, A-10, D-8..D-12).

Both follow one order: read the upper bounds, build the documents, upsert
them, and only then save the positions. A failure anywhere before the last
step repeats the pass, which the keyed upsert makes harmless (D-10).
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as C
from ..operators import state as S
from ..operators.counts import broadcast_few, counted, rows_of
from ..operators.documents import build_documents
from ..operators.quality import prune_links
from ..operators.sinks import current_version, delete, upsert
from ..schemas import DOCUMENT, ENTITIES
from ..session import checkpoint_frame
from ..sources.film import FilmTables
from ..sources.link_index import LinkIndex


@dataclass(frozen=True)
class SyncPaths:
    documents: str   # versioned document table (see operators.sinks)
    positions: str   # append-only high-water table (see operators.state)


@dataclass(frozen=True)
class PassResult:
    pass_id: int
    version: int
    positions: dict[str, dt.datetime | None]
    documents: int = 0   # A-9: documents handed to the sink in this pass


def _save(tables: FilmTables, paths: SyncPaths, highs: dict, pass_id: int) -> None:
    spark = tables.film_work.sparkSession
    rows = [(e, highs.get(e), pass_id) for e in ENTITIES]
    S.save_positions(spark.createDataFrame(rows, S.HIGH_WATER), paths.positions)


def _highs(tables: FilmTables, low: dict | None = None) -> dict[str, dt.datetime | None]:
    """Upper bounds of this pass, one small aggregate per entity (3 rows)."""
    return S.as_dict(C.current_highs(tables, ENTITIES, low))


def full_load(tables: FilmTables, paths: SyncPaths, pass_id: int = 1) -> PassResult:
    """Every film, including those with a NULL ``modified`` (D-12), once.
    Bounds are read *before* the snapshot, so changes committed during the
    load are seen again by the next pass rather than missed."""
    highs = _highs(tables)
    docs, sent = counted(build_documents(tables), "documents")
    version = upsert(docs, paths.documents, ["id"], schema=DOCUMENT, assume_unique=True)
    _save(tables, paths, highs, pass_id)
    return PassResult(pass_id, version, highs, rows_of(sent))


def changed_sets(tables: FilmTables, low: dict, high: dict,
                 look_back: dt.timedelta | None = None) -> dict[str, DataFrame]:
    """Per entity, the ids changed in ``(low - look_back, high]`` (D-8: a
    position per entity, D-9: an upper bound read up front)."""
    out = {}
    for e in ENTITIES:
        if high.get(e) is None:
            continue    # no dated row at all: nothing can have changed (D-12)
        lo = low.get(e)
        if lo is not None and look_back is not None:
            lo = lo - look_back
        out[e] = C.changed_since(C.entity_table(tables, e), lo, high.get(e))
    return out


def bounded_highs(tables: FilmTables, low: dict, high: dict, max_changes: int) -> dict:
    """O-1 for a whole pass: per entity, lower the bound to the time of its
    ``max_changes``-th oldest change in ``(low, high]``. Every change at that
    time stays in (ties are never split), so the interval remains exact and
    the next pass starts right after it."""
    out = dict(high)
    for e in ENTITIES:
        if high.get(e) is None:
            continue
        oldest = C.changed_since(C.entity_table(tables, e), low.get(e), high.get(e),
                                 limit=max_changes)
        cut = oldest.agg(F.max("modified").alias("m")).collect()[0]["m"]
        if cut is not None:
            out[e] = cut
    return out


def slice_backlog(tables: FilmTables, low: dict, high: dict, max_changes: int) -> list[dict]:
    """O-1 / O-4 for a long backlog: the upper bounds of the passes that cut
    ``(low, high]`` into about ``max_changes`` changes of each entity, oldest
    first; the last one is ``high``.

    The bounds are quantiles of ``modified`` from one sketch per entity (its
    error is a twentieth of a pass), so no pass sorts the backlog. Changes at the
    same time are never split: where many share one time, a pass is larger.
    """
    cuts = {}
    for e in ENTITIES:
        if high.get(e) is None:
            continue
        df = C.entity_table(tables, e)
        zone = df.schema["modified"].dataType
        micros = F.unix_micros(C.without_zone(F.col("modified"), zone).cast("timestamp"))
        found = C.changed_since(df, low.get(e), high[e])
        passes = -(-found.count() // max_changes)
        marks = []
        if passes > 1:
            share = [i / passes for i in range(1, passes)]
            marks = found.agg(F.percentile_approx(micros, share, 20 * passes).alias("at")).first()["at"]
        # as the bound's own type: wall-clock values without a zone
        session = tables.film_work.sparkSession
        texts = session.createDataFrame([(i, m) for i, m in enumerate(sorted(set(marks)))], "i int, m long")
        texts = texts.select("i", F.timestamp_micros("m").cast("timestamp_ntz").alias("at")).orderBy("i")
        cuts[e] = [r["at"] for r in texts.collect() if r["at"] < high[e]] + [high[e]]
    length = max(map(len, cuts.values()), default=0)
    return [{e: bounds[min(i, len(bounds) - 1)] for e, bounds in cuts.items()} for i in range(length)]


def catch_up(tables: FilmTables, paths: SyncPaths, max_changes: int, index: LinkIndex | None = None) -> list[PassResult]:
    """Work off a backlog in bounded passes (see :func:`slice_backlog`)."""
    spark = tables.film_work.sparkSession
    low = S.as_dict(S.merge_positions(S.empty_positions(spark), S.read_positions(spark, paths.positions)))
    if not low:
        return [full_load(tables, paths)]
    bounds = slice_backlog(tables, low, _highs(tables, low), max_changes)
    return [incremental_pass(tables, paths, index=index, upto=b) for b in bounds]


def remove_entities(tables: FilmTables, removed: dict[str, DataFrame], paths: SyncPaths,
                    index: LinkIndex | None = None) -> int:
    """Q-4: rows of ``removed`` (entity -> frame with ``id``) are gone from the
    sources; their links go with them and the stored documents follow: those of
    removed films are deleted, those of films linked to removed persons or genres
    built anew without them. ``tables`` are the tables before the removal.
    Returns the documents' version."""
    kept = tables.as_dict()
    for e, ids in removed.items():
        gone = ids.select(F.col("id").alias("__gone"))
        kept[e] = kept[e].join(gone, kept[e]["id"] == gone["__gone"], "left_anti")
    pruned = tables.replace(**{**kept, **prune_links(kept)})
    others = {e: ids for e, ids in removed.items() if e != "film_work"}
    if others:
        touched, found = counted(C.affected_films(tables, others, index), "films")
        touched = checkpoint_frame(touched)
        touched = broadcast_few(touched, rows_of(found))
        upsert(build_documents(pruned, touched), paths.documents, ["id"], schema=DOCUMENT, assume_unique=True)
    if "film_work" in removed:
        delete(removed["film_work"].select(F.col("id").cast("string").alias("id")), paths.documents)
    return current_version(tables.film_work.sparkSession, paths.documents)


def incremental_pass(tables: FilmTables, paths: SyncPaths,
                     look_back: dt.timedelta | None = None,
                     max_changes: int | None = None, index: LinkIndex | None = None,
                     upto: dict | None = None) -> PassResult:
    """One set-based pass over every change since the saved positions.

    The first run (no saved positions) is a full load (R-2), done once
    (D-11 fixed). Films affected by any entity are enriched once (U-1).
    ``max_changes`` bounds the work of one pass for a large backlog: each
    entity then advances by about that many changes per pass (see
    :func:`bounded_highs`); repeated passes catch up. With an ``index`` of the
    links, those of unchanged persons and genres are not read. ``upto`` gives the
    upper bounds instead of the newest changes (see :func:`catch_up`).
    """
    spark = tables.film_work.sparkSession
    saved = S.merge_positions(S.empty_positions(spark), S.read_positions(spark, paths.positions))
    low = S.as_dict(saved)
    if not low:
        return full_load(tables, paths)
    pass_id = max(r["pass_id"] for r in saved.collect()) + 1
    high = _highs(tables, low) if upto is None else upto
    # An entity without a later row keeps its old position.
    high = {e: (high.get(e) if high.get(e) is not None else low.get(e)) for e in ENTITIES}
    if max_changes is not None:
        high = bounded_highs(tables, low, high, max_changes)
    # An entity whose bound did not move has no change in (low, high] and does
    # not touch its link table; most polls end here.
    changed = {e: df for e, df in changed_sets(tables, low, high, look_back).items()
               if look_back is not None or high[e] != low.get(e)}
    version, documents = current_version(spark, paths.documents), 0
    if changed:
        # written once: the set restricts the films and both link tables
        ids, found = counted(C.affected_films(tables, changed, index), "films")
        ids = checkpoint_frame(ids)
        ids = broadcast_few(ids, rows_of(found))
        docs, sent = counted(build_documents(tables, ids), "documents")
        version = upsert(docs, paths.documents, ["id"], schema=DOCUMENT, assume_unique=True)
        documents = rows_of(sent)
    if high != low:  # a pass that moved nothing leaves no row
        _save(tables, paths, high, pass_id)
    return PassResult(pass_id, version, high, documents)


def timed_passes(spark: SparkSession, open_tables: Callable[[], FilmTables], paths: SyncPaths,
                 every: str = "1 second", passes: int | None = None, max_changes: int | None = None,
                 on_pass: Callable[[PassResult], object] | None = None) -> None:
    """R-1: an incremental pass on every tick of a trigger, over the tables as
    they are then, until the query is stopped or ``passes`` have run.

    The ticks come from Spark's rate source, whose rows are not read: the
    progress is the saved positions, so no tick is lost or repeated by a
    restart.
    """
    done = threading.Event()
    ran = []

    def tick(_: DataFrame, epoch_id: int) -> None:
        if done.is_set():
            return
        result = incremental_pass(open_tables(), paths, max_changes=max_changes)
        ran.append(result.pass_id)
        if on_pass is not None:
            on_pass(result)
        if passes is not None and len(ran) >= passes:
            done.set()

    query = (spark.readStream.format("rate").load().writeStream.foreachBatch(tick)
             .trigger(processingTime=every).start())
    while query.isActive and not done.wait(0.2):
        pass
    if query.exception() is not None:
        raise query.exception()
    query.stop()
