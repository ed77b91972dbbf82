"""Table copy (S-3, P-1..P-3) and its checks (A-7, Q-1, D-20).

Per table: project to the declared source columns, rename by name, cast to
the target types, check the result strictly, drop rows whose primary or
unique key is taken (target first, then earlier rows), append. Parents are
copied before links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import (COPY_ORDER, FOREIGN_KEYS, MAX_LENGTH, NOT_NULL, PRIMARY_KEY, RENAMES,
                       SOURCE_COLUMNS, TARGETS, UNIQUE_KEYS, SchemaMismatch, check_strict)
from ..session import checkpoint_frame, path_exists
from .counts import counted, rows_of
from .dedupe import MAX_ROUNDS, insert_if_absent


def project_source(df: DataFrame, table: str) -> DataFrame:
    """P-1 / P-2: the declared source columns only, renamed to target names.
    A missing column raises; extra ones are dropped."""
    declared = SOURCE_COLUMNS[table]
    missing = [c for c in declared if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"{table}: source lacks {missing}")
    return df.select(*[F.col(c).alias(RENAMES.get(c, c)) for c in declared])


def coerce(df: DataFrame, table: str) -> DataFrame:
    """P-3: cast to the target types. Under ANSI mode (the default) text that
    does not parse raises, as the relational insert would."""
    target = TARGETS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def coerce_or_reject(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """P-3 reject path: ``(rows that cast, rows that did not)`` with
    ``try_cast``, instead of failing the job."""
    target = TARGETS[table]
    tried = {f.name: F.col(f.name).try_cast(f.dataType) for f in target.fields}
    bad = reduce(lambda a, b: a | b,
                 [F.col(n).isNotNull() & c.isNull() for n, c in tried.items()])
    bad = bad | violations(table).isNotNull()
    good = df.where(~bad).select(*[c.alias(n) for n, c in tried.items()])
    return good, df.where(bad)


def table_keys(table: str) -> list[list[str]]:
    return [PRIMARY_KEY[table]] + UNIQUE_KEYS[table]


def copy_table(table: str, source: DataFrame, target: DataFrame | None = None,
               order_cols: list[str] | None = None,
               max_rounds: int | None = MAX_ROUNDS) -> DataFrame:
    """S-3: the rows of ``source`` to append to ``target`` (``None``: empty).

    Copying twice equals copying once: the second pass finds every key taken.
    """
    rows = typed_rows(table, source)
    return insert_if_absent(rows, target, table_keys(table), order_cols, max_rounds)


def typed_rows(table: str, source: DataFrame) -> DataFrame:
    """``source`` as rows of the target table: types, NOT NULL and lengths."""
    rows = enforce(coerce(project_source(source, table), table), table)
    check_strict(rows.schema, TARGETS[table])
    return rows


def violations(table: str) -> Column:
    """The first constraint a row breaks, as text (NULL: none): NOT NULL
    columns (the primary key among them) and greatest lengths."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{table}.{c} is NULL")) for c in NOT_NULL[table]]
    checks += [F.when(F.length(c) > n, F.lit(f"{table}.{c} is longer than {n}"))
               for c, n in MAX_LENGTH.get(table, {}).items()]
    return F.coalesce(*checks, F.lit(None).cast("string"))


def enforce(df: DataFrame, table: str) -> DataFrame:
    """Fail on a row that breaks a constraint of the target table, as the
    relational insert would; checked while the rows are written."""
    broken = violations(table)
    first = df.columns[0]
    checked = F.when(broken.isNotNull(), F.raise_error(broken)).otherwise(F.col(first))
    return df.withColumn(first, checked.cast(TARGETS[table][first].dataType))


UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def uuid_keys(df: DataFrame, table: str) -> DataFrame:
    """SURVEY 1.2: the id columns of a source with uuid keys, in lower case;
    a value that is no uuid fails the job. (The keys of the stand-in views are
    numbers, so this is a step of its own.)"""
    ids = [f.name for f in TARGETS[table].fields if f.name == "id" or f.name.endswith("_id")]
    return df.withColumns({c: F.when(F.col(c).rlike(UUID) | F.col(c).isNull(), F.lower(c))
                           .otherwise(F.raise_error(F.concat(F.lit(f"{table}.{c} is no uuid: "), F.col(c)))) for c in ids})


def append_rows(df: DataFrame, table: str, path: str) -> None:
    """Append accepted rows to the target table folder (strictly typed)."""
    check_strict(df.schema, TARGETS[table])
    df.write.mode("append").parquet(path)


def _counts(frames: dict[str, DataFrame], col: str) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias(col)).select(F.lit(name).alias("table_name"), col)
             for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def count_parity(sources: dict[str, DataFrame], targets: dict[str, DataFrame]) -> DataFrame:
    """A-7 / Q-1: row counts per table on both sides, and whether they agree.
    Every table is checked (D-19 fixed: no stop at the first blank name)."""
    return _parity(_counts(sources, "source_rows"), _counts(targets, "target_rows"))


def _parity(src: DataFrame, tgt: DataFrame) -> DataFrame:
    return (src.join(tgt, "table_name", "full")
            .select("table_name", "source_rows", "target_rows",
                    (F.coalesce(F.col("source_rows"), F.lit(-1))
                     == F.coalesce(F.col("target_rows"), F.lit(-1))).alias("match")))


def key_parity(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """D-20: keys missing from the target and keys only in the target,
    which equal totals cannot reveal."""
    s = source.select(*key)
    t = target.select(*key)
    missing = s.join(t, key, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    extra = t.join(s, key, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return (missing.select(F.lit("missing_in_target").alias("check"), "n")
            .unionByName(extra.select(F.lit("only_in_target").alias("check"), "n")))


class OrphanLinks(ValueError):
    """Link rows whose non-NULL foreign key has no parent (D-18)."""


def _mark_orphans(rows: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with ``__orphan``: the foreign keys (of ``parents``, whose ids are
    unique) that are not NULL and find no parent. One pass, one join per key."""
    cols, lost = rows.columns, []
    for i, (col, parent) in enumerate(parents.items()):
        ids = parent.select(F.col("id").alias(f"__parent{i}"))
        rows = rows.join(ids, F.col(col) == F.col(f"__parent{i}"), "left")
        lost.append(F.when(F.col(col).isNotNull() & F.col(f"__parent{i}").isNull(), F.lit(col)))
    return rows.select(*cols, F.array_compact(F.array(*lost)).alias("__orphan"))


def _checked_links(rows: DataFrame, table: str, parents: dict[str, DataFrame], drop: bool) -> DataFrame:
    """Link rows whose parents exist, written once: the check and keep-first
    read what this one pass leaves."""
    seen = Observation(f"orphans of {table}")
    marked = _mark_orphans(rows, parents)
    marked = checkpoint_frame(marked.observe(seen, *[
        F.count_if(F.array_contains("__orphan", col)).alias(col) for col in parents]))
    found = {col: n for col, n in seen.get.items() if n}
    if found and not drop:
        raise OrphanLinks(f"{table}: rows point at missing parents: {found}")
    return marked.where(F.size("__orphan") == 0).drop("__orphan")


def copy_tables(sources: dict[str, DataFrame], target_root: str,
                tables: list[str] | None = None, on_orphans: str = "fail",
                order_cols: dict[str, list[str]] | None = None, uuids: bool = False) -> DataFrame:
    """S-3: the whole copy job, parents before links; returns the parity
    report of every copied table (D-19: none is skipped).

    Each table's target is the parquet folder ``<target_root>/<table>``
    (absent = empty). Link rows pointing at a parent that is in neither the
    target nor this copy abort the job by default, as the relational insert
    would (D-18); ``on_orphans="drop"`` leaves them out instead. With ``uuids``
    the id columns must be uuids, which are written in lower case (P-3).

    Every source is evaluated once: its rows are counted as they pass.
    """
    if on_orphans not in ("fail", "drop"):
        raise ValueError("on_orphans is 'fail' or 'drop'")
    spark = next(iter(sources.values())).sparkSession
    wanted = [t for t in COPY_ORDER if t in (tables or sources) and t]
    copied: dict[str, DataFrame] = {}
    found: dict[str, int] = {}
    for table in wanted:
        path = f"{target_root.rstrip('/')}/{table}"
        target = _read_target(spark, path, table)
        source, seen = counted(sources[table], f"source of {table}")
        rows = typed_rows(table, source)
        if uuids:
            rows = uuid_keys(rows, table)
        parents = {col: _read_target(spark, f"{target_root.rstrip('/')}/{parent}", parent)
                   for link, col, parent in FOREIGN_KEYS if link == table}
        if parents:  # before keep-first: an orphan must not take a valid row's key
            parents = {col: spark.createDataFrame([], TARGETS["genre"]) if df is None else df for col, df in parents.items()}
            rows = _checked_links(rows, table, parents, on_orphans == "drop")
        rows = insert_if_absent(rows, target, table_keys(table), (order_cols or {}).get(table))
        append_rows(rows, table, path)
        found[table] = rows_of(seen)
        copied[table] = _read_target(spark, path, table)
    return _parity(spark.createDataFrame(sorted(found.items()), "table_name string, source_rows long"),
                   _counts(copied, "target_rows"))


def _read_target(spark, path: str, table: str) -> DataFrame | None:
    return spark.read.schema(TARGETS[table]).parquet(path) if path_exists(spark, path) else None


PLACES = 1024  # buckets of keys whose checksums are compared


def _hashed(df: DataFrame, table: str, places: int) -> DataFrame:
    """Key, its bucket, and a hash of the whole row (NULLs at their place)."""
    key = PRIMARY_KEY[table]
    row = F.xxhash64(*[F.coalesce(F.col(f.name).cast("string"), F.lit("\\N")) for f in TARGETS[table].fields])
    return df.select(*key, F.pmod(F.xxhash64(*key), F.lit(places)).cast("int").alias("place"), row.alias("row"))


def unequal_rows(table: str, source: DataFrame, target: DataFrame, places: int = PLACES) -> DataFrame:
    """Q-1 / D-20, rows and not only their number: keys of ``source`` and
    ``target`` (rows of the target's types) whose rows differ, with ``kind``
    ``missing``, ``extra`` or ``altered``.

    Both sides are summed up per bucket of keys: a count and a sum of row hashes,
    which no order changes and every task adds up for itself. Only the rows of
    unequal buckets (at most ``places`` numbers go through the driver) are then
    shuffled and compared by key; in equal tables that is none. A key that
    repeats on a side is compared by its rows' hashes added up.
    """
    sides = [_hashed(df, table, places) for df in (source, target)]
    sums = [df.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("row").cast("decimal(38,0)")).alias("sum"))
            .select("place", F.struct("n", "sum").alias(name)) for df, name in zip(sides, ("s", "t"))]
    unequal = [r[0] for r in sums[0].join(sums[1], "place", "full").where("not (s <=> t)").select("place").collect()]
    key = PRIMARY_KEY[table]
    rows = [df.where(F.col("place").isin(unequal)).groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("row").cast("decimal(38,0)")).alias("sum"))
        .select(*key, F.struct("n", "sum").alias(name)) for df, name in zip(sides, ("s", "t"))]
    kind = F.when(F.col("t").isNull(), "missing").when(F.col("s").isNull(), "extra").otherwise("altered")
    return rows[0].join(rows[1], key, "full").where("not (s <=> t)").select(*key, kind.alias("kind"))
