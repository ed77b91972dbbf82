"""Helpers the operators share: lineage cuts, ordered neighbours, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remove_path, shared_path


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the folder named by ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ranged(df: DataFrame, *order) -> DataFrame:
    """``df`` written in order, with ``_part``: all rows of a part come before
    those of the next. Tasks sort their own part only."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpoint(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``fp`` and ``component_id`` of every row of ``nodes`` (``fp``, ``least``):
    the smallest ``least`` among the nodes that ``links`` (``a``, ``b``) reach.

    Alternating star contraction: a node's neighbours are hung below the
    smallest node known to it, in turns for the greater and the smaller ones,
    until nothing changes. Minima are combined before the shuffle, and joins on
    a node with very many neighbours can be split, as both sides are shuffled
    for the join alone.
    """
    edges = checkpoint(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(checkpoint(least), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpoint(large.where("u != v").distinct())
        least = checkpoint(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u")
        small = small.select("v", "m").union(small.select("u", "m")).toDF("u", "v")
        edges = checkpoint(small.where("u != v").distinct())
    roots = edges.toDF("fp", "root")
    members = checkpoint(nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    smallest = checkpoint(members.groupBy("root").agg(F.min("least").alias("component_id")))
    return members.join(smallest, "root").select("fp", "component_id")


def following(ids: DataFrame, id: str, out: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``ids`` (one row per id, any further columns) with the struct ``out`` of
    the next greater id (``id``) and its columns ``carry``; the greatest id gets
    the smallest.

    NULL comes first, as one id. Only the first id of each part, a row per
    shuffle partition, is brought together.
    """
    parts = ranged(ids, id)
    whole = F.struct(F.col(id).isNotNull().alias("known"), F.col(id).alias("id"), *carry)
    inside = Window.partitionBy("_part").orderBy(F.col(id).asc_nulls_first())
    across = Window.orderBy("_part")
    heads = parts.groupBy("_part").agg(F.min(whole).alias("head"))
    heads = heads.select("_part", F.coalesce(
        F.lead("head").over(across),
        F.first("head").over(across.rowsBetween(Window.unboundedPreceding, 0))).alias("after"))
    return (parts.withColumn("_next", F.lead(whole).over(inside)).join(F.broadcast(heads), "_part")
            .withColumn(out, F.coalesce("_next", "after")).drop("_part", "_next", "after"))


def running(df: DataFrame, order: list[str], sums: dict[str, F.Column]) -> DataFrame:
    """``df`` with each ``sums`` column added up over the rows before it in
    ``order`` (ascending, NULLs last; it must tell all rows apart).

    Each task adds up its own range; only a row of totals per shuffle
    partition is brought together.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    valued = df.select("*", *[v.alias(f"_{k}") for k, v in sums.items()])
    parts = ranged(valued, *by)
    inside = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(*[F.sum(f"_{k}").alias(f"_t_{k}") for k in sums])
    offsets = totals.select("_part", *[F.sum(f"_t_{k}").over(across).alias(f"_o_{k}") for k in sums])
    added = {k: F.coalesce(F.sum(f"_{k}").over(inside), F.lit(0)) for k in sums}
    out = parts.select("*", *[v.alias(f"_s_{k}") for k, v in added.items()]).join(F.broadcast(offsets), "_part")
    return out.select(*df.columns, *[(F.col(f"_s_{k}") + F.coalesce(f"_o_{k}", F.lit(0))).alias(k) for k in sums])


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``stored`` wrote inside it. What is computed from
    them must have been written before it ends."""
    token = _MADE.set([])
    try:
        yield
    finally:
        made = _MADE.get()
        _MADE.reset(token)
        for path in made:
            remove_path(spark, path)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table below ``spark.checkpoint.dir`` and read again,
    so that Spark knows its size and chooses joins by it."""
    path = shared_path(df.sparkSession, "tables", unique=True)
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
