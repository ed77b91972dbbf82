"""Data quality: Q-2 constraints, Q-3 dangling links, Q-4 cascade pruning.

Each check is one aggregate per table (violation counts computed together in
a single scan), reported as long rows ``(table_name, column_name, rule,
violations)`` so any number of tables and rules union cleanly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, MAX_LENGTH, NOT_NULL


def _count_if(cond: F.Column) -> F.Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Q-2: NOT NULL and length violations per table and column."""
    parts = []
    for name, df in tables.items():
        checks = [(c, "not_null", F.col(c).isNull()) for c in NOT_NULL.get(name, [])]
        checks += [(c, f"max_length_{n}", F.length(F.col(c)) > n)
                   for c, n in MAX_LENGTH.get(name, {}).items()]
        if not checks:
            continue
        agg = df.agg(*[_count_if(cond).alias(f"v{i}") for i, (_, _, cond) in enumerate(checks)])
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"),
                                  F.col(f"v{i}").alias("violations"))
                         for i, (c, rule, _) in enumerate(checks)])
        parts.append(agg.select(F.lit(name).alias("table_name"), F.explode(rows).alias("r"))
                     .select("table_name", "r.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _parents(parent: DataFrame, tag: str) -> DataFrame:
    return parent.select(F.col("id").alias(f"__{tag}_id"), F.lit(True).alias(f"__{tag}_hit"))


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Q-3: per foreign key, link rows whose non-NULL key has no parent.
    A NULL key is not a violation."""
    parts = []
    for link, col, parent in FOREIGN_KEYS:
        links = tables[link].where(F.col(col).isNotNull()).select(col)
        ids = tables[parent].select(F.col("id").alias("__pid"))
        orphans = links.join(ids, links[col] == ids["__pid"], "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("orphans"))
                     .select(F.lit(link).alias("table_name"), F.lit(col).alias("column_name"),
                             F.lit(parent).alias("parent_table"), "orphans"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def prune_links(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Q-4: the link tables after their parents' deletes cascade: rows whose
    every non-NULL foreign key finds its parent. Parents are unique by id, so
    a left join with a marker never multiplies rows."""
    out: dict[str, DataFrame] = {}
    for link in sorted({fk[0] for fk in FOREIGN_KEYS}):
        df = tables[link]
        cols = df.columns
        keep = F.lit(True)
        for i, (lt, col, parent) in enumerate(k for k in FOREIGN_KEYS if k[0] == link):
            p = _parents(tables[parent], f"p{i}")
            df = df.join(p, df[col] == p[f"__p{i}_id"], "left")
            keep = keep & (F.col(col).isNull() | F.col(f"__p{i}_hit").isNotNull())
        out[link] = df.where(keep).select(*cols)
    return out
