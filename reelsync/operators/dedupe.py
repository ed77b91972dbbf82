"""A-8 / D-17: keep-first de-duplication on one or more unique keys.

"First" needs an explicit sequence: Spark input has no row order. The
sequence is the given order columns, then every column (and, with several
keys, a row number, so exact duplicate rows still conflict with each other).

One key: the first row per key is ``min(struct(sequence, row))`` per key, an
aggregate Spark combines map-side before the shuffle, so a key holding a third
of all rows costs one partial aggregate per task, not a sort of the group.

Several keys: a row is accepted in sequence order unless a key of it is
already taken by an accepted row. De-duplicating by one key and then the
other is wrong ((1,a), (2,a), (2,b) keeps the 1st and 3rd, the shortcut drops
the 3rd). A row that shares no key with another is accepted at once; the rest
goes through rounds: accept every remaining row that is first in *all*
its key groups, then drop every remaining row sharing a key with an accepted
one. The first remaining row is always accepted, so this ends. Rows are
ranked once by a parallel sort (a long row number), the rounds shuffle only
that rank and the key columns, and each round's sets are written to the
shared checkpoint folder to cut lineage. A NULL key part never conflicts, as
in a relational unique index.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_frame, ensure_checkpoint_dir
from .counts import broadcast_few, counted, rows_of

RID = "__rid"
#: Links of a chain of conflicts (one round each) beyond which keep-first raises.
MAX_ROUNDS = 1_000


def _key_eq(left: DataFrame, right: DataFrame, key: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b,
                  [left[k] == right[f"{prefix}{k}"] for k in key])


def _has_null(key: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])


def sequence(columns: list[str], order_cols: list[str] | None) -> Column:
    order = list(order_cols or [])
    rest = [c for c in columns if c not in order]
    return F.struct(*[F.col(c) for c in order + rest])


def drop_conflicts(df: DataFrame, target: DataFrame | None, keys: list[list[str]]) -> DataFrame:
    """J-7: drop rows whose (non-NULL) key is already in the target; ``=`` not
    ``<=>``, so NULL keys never match."""
    if target is None:
        return df
    for i, key in enumerate(keys):
        prefix = f"__t{i}_"
        taken = target.select(*[F.col(k).alias(f"{prefix}{k}") for k in key])
        df = df.join(taken, _key_eq(df, taken, key, prefix), "left_anti")
    return df


def keep_first(df: DataFrame, key: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """First row per key in sequence order; rows with a NULL key part all stay.

    One scan and one aggregate: a row with a NULL key part gets a number of
    its own as a further grouping column, so it forms its own group.
    """
    cols = df.columns
    solo = F.when(_has_null(key), F.monotonically_increasing_id())
    # The sequence struct holds every column, so its minimum is the row.
    return (df.withColumn("__solo", solo).groupBy(*key, "__solo")
            .agg(F.min(sequence(cols, order_cols)).alias("m"))
            .select(*[F.col("m")[c].alias(c) for c in cols]))


def tag_conflicts(df: DataFrame, keys: list[list[str]]) -> DataFrame | None:
    """``df`` with ``__conflict``: whether another row shares one of its keys
    (``None``: no key repeats).

    Only key columns are counted, after a map-side partial count. The keys that
    repeat are written down first, so that rows are joined to them only where
    there are any, and not shuffled for it where they are few.
    """
    flags = []
    for i, key in enumerate(keys):
        prefix = f"__d{i}_"
        groups = df.where(~_has_null(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
        repeated = groups.where(F.col("__n") > 1).select(
            *[F.col(k).alias(f"{prefix}{k}") for k in key], F.lit(True).alias(f"{prefix}hit"))
        repeated, found = counted(repeated, f"repeated keys {i}")
        repeated = checkpoint_frame(repeated)
        if not rows_of(found):
            continue
        repeated = broadcast_few(repeated, rows_of(found))
        df = df.join(repeated, _key_eq(df, repeated, key, prefix), "left").drop(*[f"{prefix}{k}" for k in key])
        flags.append(F.col(f"{prefix}hit").isNotNull())
    if not flags:
        return None
    return (df.withColumn("__conflict", reduce(lambda a, b: a | b, flags))
            .drop(*[f"__d{i}_hit" for i in range(len(keys))]))


def rank_rows(df: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """Rows with ``__rid``, their position in sequence order (a long).

    A global sort range-partitions the rows (parallel, no single task sees
    them all); ids taken right after it grow in sort order. The result is
    checkpointed so the ids never change on recomputation; identical rows
    get distinct ids in arbitrary order, which cannot change the outcome.
    """
    cols = df.columns
    order = list(order_cols or []) + [c for c in cols if c not in (order_cols or [])]
    # The last key only orders identical rows: it lets the range partitioner
    # split a large group of exact copies across tasks instead of sending it
    # to one.
    ranked = df.orderBy(*[F.col(c).asc_nulls_first() for c in order], F.rand(17))
    return ranked.withColumn(RID, F.monotonically_increasing_id()).checkpoint()


def accepted_ids(slim: DataFrame, keys: list[list[str]], max_rounds: int | None = None) -> DataFrame:
    """The greedy rounds on ``(__rid, key columns)`` only; returns accepted ``__rid``s."""
    accepted: list[DataFrame] = []
    remaining = slim
    rounds = 0
    while not remaining.isEmpty():
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"keep-first over {len(keys)} keys needs more than "
                               f"{max_rounds} rounds")
        cand = remaining
        firsts = []
        for i, key in enumerate(keys):
            prefix = f"__k{i}_"
            mins = (remaining.groupBy(*key).agg(F.min(RID).alias(f"{prefix}min"))
                    .select(*[F.col(k).alias(f"{prefix}{k}") for k in key], f"{prefix}min"))
            cand = cand.join(mins, _key_eq(cand, mins, key, prefix), "left")
            firsts.append(F.col(f"{prefix}min").isNull() | (F.col(RID) == F.col(f"{prefix}min")))
        won = cand.where(reduce(lambda a, b: a & b, firsts)).select(*slim.columns).checkpoint()
        accepted.append(won.select(RID))
        left = remaining.join(won.select(RID), RID, "left_anti")
        remaining = drop_conflicts(left, won, keys).checkpoint()
    if not accepted:
        return slim.select(RID).where(F.lit(False))
    return reduce(lambda a, b: a.unionByName(b), accepted)


def keep_first_keys(df: DataFrame, keys: list[list[str]],
                    order_cols: list[str] | None = None,
                    max_rounds: int | None = MAX_ROUNDS) -> DataFrame:
    """Greedy keep-first over several unique keys, by rounds (see module doc).

    A row that shares no key with another row is accepted as it stands; only
    the rest is ranked and goes through the rounds, which shuffle just the
    rank and the key columns. A chain of conflicts that needs more than
    ``max_rounds`` rounds raises instead of returning a partial answer
    (``None``: no limit).
    """
    if len(keys) == 1:
        return keep_first(df, keys[0], order_cols)
    ensure_checkpoint_dir(df.sparkSession)
    cols = df.columns
    tagged = tag_conflicts(df, keys)
    if tagged is None:  # no row has a rival: nothing to rank, nothing to write
        return df
    tagged = tagged.checkpoint()
    alone = tagged.where(~F.col("__conflict")).select(*cols)
    ranked = rank_rows(tagged.where("__conflict").select(*cols), order_cols)
    key_cols = list(dict.fromkeys(c for key in keys for c in key))
    ids = accepted_ids(ranked.select(RID, *key_cols), keys, max_rounds)
    return alone.unionByName(ranked.join(ids, RID, "left_semi").select(*cols))


def insert_if_absent(df: DataFrame, target: DataFrame | None, keys: list[list[str]],
                     order_cols: list[str] | None = None,
                     max_rounds: int | None = MAX_ROUNDS) -> DataFrame:
    """S-4 / J-7 / A-8: rows to append so that no unique key is duplicated.

    Rows conflicting with the target are dropped first (the target's rows
    win); among the rest an earlier row wins.
    """
    return keep_first_keys(drop_conflicts(df, target, keys), keys, order_cols, max_rounds)
