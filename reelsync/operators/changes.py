"""Change detection: which rows changed, and which films they touch.

Set-based: one pass over the interval ``(low, high]`` per entity instead of
the reference's repeat-until-empty loop of 100-id batches with a growing
exclusion list. Positions are literals, so the ``modified`` bounds reach the
parquet scan as pushed filters (row groups outside the interval are skipped).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENTITIES
from ..sources.film import FilmTables
from ..sources.link_index import LINKS, LinkIndex

Position = dt.datetime | None


def position_literal(pos: dt.datetime, ts_type: T.DataType) -> F.Column:
    """A position typed like the column it bounds, so the comparison needs no
    cast of the column and is pushed to the scan as is.

    Positions are wall-clock values without a zone; for a column that marks
    instants they are in UTC. Neither the driver's zone nor the session's takes
    part: a Python datetime literal would be read in the driver's."""
    if isinstance(ts_type, T.TimestampType):
        return F.timestamp_micros(F.lit(epoch_micros(pos)))
    return F.lit(pos.isoformat(sep=" ")).cast(T.TimestampNTZType()).cast(ts_type)


def epoch_micros(pos: dt.datetime) -> int:
    return (pos - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def without_zone(col: F.Column, ts_type: T.DataType) -> F.Column:
    """An instant as its UTC wall-clock value; other types just cast."""
    if not isinstance(ts_type, T.TimestampType):
        return col.cast(T.TimestampNTZType())
    seconds = (F.unix_micros(col).cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    return (F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
            + F.make_dt_interval(zero, zero, zero, seconds))


def changed_since(df: DataFrame, low: Position = None, high: Position = None,
                  limit: int | None = None, id_col: str = "id",
                  ts_col: str = "modified") -> DataFrame:
    """P-4 / P-5 / O-1: rows with ``low < modified <= high`` as ``(id, modified)``.

    ``low=None`` is the first load (no lower bound); a NULL ``modified`` never
    satisfies a bound, so with ``high`` only dated rows remain. ``limit`` keeps the oldest ``limit`` changes, ties
    broken by id, for a bounded catch-up pass.
    """
    out = df.select(F.col(id_col).alias("id"), F.col(ts_col).alias("modified"))
    ts_type = df.schema[ts_col].dataType
    if low is not None:
        out = out.where(F.col("modified") > position_literal(low, ts_type))
    if high is not None:
        out = out.where(F.col("modified") <= position_literal(high, ts_type))
    if limit is not None:
        out = out.orderBy(F.col("modified").asc_nulls_last(), F.col("id")).limit(limit)
    return out


def exclude_processed(changed: DataFrame, processed: DataFrame | None) -> DataFrame:
    """P-6 / J-6: drop ids already handled. An anti join (never ``NOT IN``,
    which is null-aware and plans as a slower broadcast nested loop)."""
    if processed is None:
        return changed
    done = processed.select(F.col("id").alias("__done"))
    return changed.join(done, changed["id"] == done["__done"], "left_anti")


def accumulate_processed(processed: DataFrame | None, batch: DataFrame) -> DataFrame:
    """U-2: the set of ids handled so far."""
    ids = batch.select("id")
    return ids.distinct() if processed is None else processed.select("id").union(ids).distinct()


def linked_film_ids(changed: DataFrame, links: DataFrame, entity_col: str) -> DataFrame:
    """Film ids of link rows whose entity changed, as column ``id`` (may repeat)."""
    # Changed ids are usually few: where their measured size allows it,
    # adaptive execution broadcasts them and the links are not shuffled.
    keys = changed.select(F.col("id").alias("__changed"))
    hit = links.join(keys, links[entity_col] == keys["__changed"], "left_semi")
    return hit.select(F.col("film_work_id").alias("id"))


def _candidates(tables: FilmTables, changed: DataFrame, entity: str, index: LinkIndex | None) -> DataFrame:
    """Film ids linked to changed entities: from the index where there is one,
    else from all links."""
    if index is not None:
        return index.linked_film_ids(changed, entity)
    table, col = LINKS[entity]
    return linked_film_ids(changed, tables.as_dict()[table], col)


def films_by_entity(tables: FilmTables, changed: DataFrame, entity: str, index: LinkIndex | None = None) -> DataFrame:
    """J-5: distinct ids of existing films linked to changed persons or genres.

    Written as a semi join of the film table: each film once, no DISTINCT
    shuffle, and links to missing films are ignored as in the inner join the
    reference's SQL amounts to.
    """
    return _existing_films(tables, _candidates(tables, changed, entity, index))


def _existing_films(tables: FilmTables, candidates: DataFrame) -> DataFrame:
    """Film rows among ``candidates`` (column ``id``, may repeat)."""
    # distinct() first: a film linked to very many changed rows repeats in
    # the candidates; the partial aggregate collapses it in every task, so
    # the join's build side does not carry it.
    cand = candidates.select(F.col("id").alias("__cand")).distinct()
    films = tables.film_work.select("id")
    return films.join(cand, films["id"] == cand["__cand"], "left_semi")


def affected_films(tables: FilmTables, changed: dict[str, DataFrame], index: LinkIndex | None = None) -> DataFrame:
    """U-1 / O-4: films touched by changed films, persons or genres.

    A changed film affects itself (D-6 fixed); person and genre changes fan
    out through their links. The candidates are unioned and the film table is
    semi-joined once, which both de-duplicates and drops dangling links.
    """
    parts = []
    if changed.get("film_work") is not None:
        parts.append(changed["film_work"].select("id"))
    for entity in ("person", "genre"):
        if changed.get(entity) is not None:
            parts.append(_candidates(tables, changed[entity], entity, index))
    if not parts:
        return tables.film_work.select("id").where(F.lit(False))
    cand = parts[0]
    for p in parts[1:]:
        cand = cand.unionByName(p)
    return _existing_films(tables, cand)


def entity_table(tables: FilmTables, entity: str) -> DataFrame:
    return tables.as_dict()[entity]


def current_highs(tables: FilmTables, entities: list[str],
                  low: dict[str, Position] | None = None) -> DataFrame:
    """A-10 / D-9: the upper bound of a pass, ``max(modified)`` per entity,
    read *before* the changed rows so later commits wait for the next pass.
    With ``low`` only rows after an entity's position are read (the filter is
    pushed to the scan); without such a row the bound is NULL."""
    def high(e: str) -> DataFrame:
        df = entity_table(tables, e)
        position = without_zone(F.col("position"), df.schema["modified"].dataType)
        df = changed_since(df, (low or {}).get(e))
        return (df.agg(F.max("modified").alias("position"))
                .select(F.lit(e).alias("entity"), position.alias("position")))

    frames = [high(e) for e in entities]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
