"""Sinks: keyed latest-wins upsert (S-5), strict targets (S-6), bulk records
(S-7), and the pluggable document writer (S-8).

The upsert target is a folder of immutable bucket files plus a version log
(``versions.py``):

    <path>/data/v=00000003-<attempt>/__bucket=7/   rows of bucket 7
    <path>/_versions/00000003.json                 which folders make up version 3

A row's bucket is a hash of its key. An upsert writes the rows it was sent and
nothing else: per touched bucket one more layer of changes over the base, so
its bytes follow the batch and not the table. A read lays the changes over the
base, the newest (or the greatest version columns) per key; buckets without
changes are read as they are. A bucket whose changes pass ``SHARE`` of its base
gets a new base in the same commit, so a row is rewritten once per that many
changes (where an update always replaces its row, the rows just written become
the base, and only those they leave are written beside them); one with more than ``LAYERS`` small layers gets them merged into one,
without reading the base. ``rebucket`` writes a grown table in more buckets.
``delete`` lays tombstones over the base, rows that say that their key is gone.

A write never touches files being read, and every attempt has a folder of its
own: a crash before the log file leaves the old version current and costs some
unused files (``vacuum`` removes them), and a repeated batch is harmless (R-5).
There is one writer per table at a time (one scheduled job or one streaming
query); a write that finds its version taken removes its own folder and raises
``ConcurrentWrite``, and the table is the other writer's. Bucket folders that
none of the last ``keep`` versions uses are removed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import check_strict
from ..session import checkpoint_frame, list_names, remove_path
from . import versions as V
from .counts import broadcast_few, counted, rows_of
from .versions import BUCKET, ConcurrentWrite, Version

__all__ = ["ConcurrentWrite", "bulk_records", "current_version", "delete", "ensure_target", "latest_per_key", "merge_latest",
           "read_current", "rebucket", "upsert", "vacuum", "write_bulk", "write_documents"]

BUCKETS = 32     # of a new table; each holds about 1/32 of the keys
KEEP = 2         # versions whose files stay readable
SHARE = 0.25     # of a base's rows that its changes may reach
LAYERS = 8       # of changes over a base
SEQUENCE = "__sequence"
GONE = "__gone"  # of a change: its key has no row any more


def latest_per_key(df: DataFrame, key: list[str], version_cols: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest ``version_cols`` (then the greatest row,
    so ties are deterministic). Aggregated map-side before the shuffle."""
    cols = df.columns
    order = [F.col(c) for c in (version_cols or [])]
    best = F.max(F.struct(F.struct(*order).alias("v") if order else F.lit(0).alias("v"),
                          F.struct(*cols).alias("row")))
    return df.groupBy(*key).agg(best.alias("m")).select("m.row.*")


def dedupe_updates(updates: DataFrame, key: list[str],
                   version_cols: list[str] | None = None,
                   assume_unique: bool = False) -> DataFrame:
    """R-4: one update per key, the latest; with ``assume_unique`` (the
    caller's guarantee) the updates as they are."""
    return updates if assume_unique else latest_per_key(updates, key, version_cols)


def merge_latest(target: DataFrame | None, updates: DataFrame, key: list[str],
                 version_cols: list[str] | None = None,
                 assume_unique: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """S-5: the target with ``updates`` applied by key.

    Without ``version_cols`` an update replaces the stored row (a keyed index
    operation). With them the newer version wins and a tie goes to the update.
    Only target rows whose key is updated take part in the contest; the rest
    pass through an anti join. ``keys`` are those of ``updates`` (may repeat),
    where the caller has them without the work that finds the updates.
    """
    upd = dedupe_updates(updates, key, version_cols, assume_unique)
    if target is None:
        return upd
    target = target.select(*upd.columns)
    # An incremental batch updates few keys of a large table: where their
    # measured size allows it, adaptive execution broadcasts them.
    keys = (upd if keys is None else keys).select(*[F.col(k).alias(f"__u_{k}") for k in key])
    cond = [target[k] == keys[f"__u_{k}"] for k in key]
    untouched = target.join(keys, cond, "left_anti")
    if not version_cols:
        return untouched.unionByName(upd)
    touched = target.join(keys, cond, "left_semi")
    contest = (touched.withColumn("__pri", F.lit(0))
               .unionByName(upd.withColumn("__pri", F.lit(1))))
    winners = latest_per_key(contest, key, list(version_cols) + ["__pri"]).drop("__pri")
    return untouched.unionByName(winners)


def current_version(spark: SparkSession, path: str) -> int:
    known = V.numbers(spark, path)
    return known[-1] if known else 0


def _read(spark: SparkSession, schema: T.StructType, folders: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _changes(spark: SparkSession, path: str, version: Version, buckets: list[int]) -> DataFrame:
    """The last change of each key in the layers above the bases of ``buckets``,
    with ``GONE``."""
    rows, layers = _layers(spark, path, version, buckets)
    if layers == 1:  # a layer has one row per key
        return rows.drop(SEQUENCE)
    return latest_per_key(rows, version.key, [*version.order, SEQUENCE]).drop(SEQUENCE)


def _layers(spark: SparkSession, path: str, version: Version, buckets: list[int]) -> tuple[DataFrame, int]:
    """All rows of the layers above the bases of ``buckets``, with ``GONE`` and
    ``SEQUENCE``, and the number of these layers."""
    schema = T.StructType([*version.struct().fields, T.StructField(GONE, T.BooleanType())])
    by_age: dict[int, list[str]] = {}
    for b in buckets:
        for folder, _, number in version.layers[b][1:]:
            by_age.setdefault(number, []).append(V.bucket_path(path, folder, b))
    parts = [_read(spark, schema, folders).withColumn(SEQUENCE, F.lit(number))
             for number, folders in sorted(by_age.items())]
    return reduce(lambda a, b: a.unionByName(b), parts), len(parts)


def _resolved(spark: SparkSession, path: str, version: Version, buckets: list[int]) -> DataFrame:
    """The rows of ``buckets``, changes laid over their bases."""
    bases = lambda chosen: [V.bucket_path(path, version.layers[b][0][0], b) for b in chosen]
    plain = [b for b in buckets if len(version.layers[b]) == 1]
    changed = [b for b in buckets if len(version.layers[b]) > 1]
    if not changed:
        return _read(spark, version.struct(), bases(plain))
    held = _read(spark, version.struct(), bases(changed)).withColumn(GONE, F.lit(None).cast("boolean"))
    # the keys straight from the layers: a scan of these columns, no contest
    merged = merge_latest(held, _changes(spark, path, version, changed), version.key, version.order, assume_unique=True,
                          keys=_layers(spark, path, version, changed)[0])
    merged = merged.where(F.col(GONE).isNull()).drop(GONE)
    return _read(spark, version.struct(), bases(plain)).unionByName(merged) if plain else merged


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 version: int | None = None) -> DataFrame | None:
    """The table (``None``: there is none), or one of its kept versions."""
    state = V.load(spark, path, version)
    if state is None:
        return None
    rows = _resolved(spark, path, state, [b for b, layers in enumerate(state.layers) if layers])
    return rows if schema is None else rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def ensure_target(spark: SparkSession, path: str, schema: T.StructType,
                  buckets: int = BUCKETS) -> DataFrame:
    """S-6: create an empty version 1 with ``schema`` unless a version exists;
    an existing target must have exactly that schema."""
    if V.load(spark, path) is None:
        V.publish(spark, path, Version(1, schema.json(), [], [], [[] for _ in range(buckets)]))
    check_strict(V.load(spark, path).struct(), schema)
    return read_current(spark, path)


def _place(key: list[str], buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, folder: str, key: list[str], buckets: int, mode: str = "error") -> dict[int, int]:
    """Write ``rows`` by bucket; returns each written bucket's number of rows
    (from the new files' footers)."""
    spark, target = rows.sparkSession, f"{path}/data/{folder}"
    # rebalanced by bucket: few files per bucket, and a large bucket is split
    (rows.withColumn(BUCKET, _place(key, buckets)).hint("rebalance", BUCKET)
     .write.mode(mode).partitionBy(BUCKET).parquet(target))
    read = T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return {r[0]: r[1] for r in spark.read.schema(read).parquet(target).groupBy(BUCKET).count().collect()}


def upsert(updates: DataFrame, path: str, key: list[str],
           version_cols: list[str] | None = None,
           schema: T.StructType | None = None,
           assume_unique: bool = False, buckets: int = BUCKETS, keep: int = KEEP,
           share: float = SHARE, layers: int = LAYERS, create: bool = True) -> int:
    """Apply ``updates`` to the table at ``path``; returns the new version.

    The updates are evaluated and written once; the table is read only where a
    bucket gets a new base. An empty update is a no-op (no new version) on an
    existing table, and where there is none unless ``create``. ``assume_unique`` is the caller's guarantee that ``updates``
    has one row per key (documents built from a table keyed by film id). Key and
    version columns are those of the first upsert.
    """
    spark = updates.sparkSession
    if schema is not None:
        check_strict(updates.schema, schema)
    state = V.load(spark, path)
    if state is None:
        state = Version(0, (schema or updates.schema).json(), [], [], [[] for _ in range(buckets)])
    if state.key and [state.key, state.order] != [list(key), list(version_cols or [])]:
        raise ValueError(f"{path} has key {state.key} and version columns {state.order}")
    state = replace(state, key=list(key), order=list(version_cols or []))
    rows = dedupe_updates(updates.select(*state.struct().fieldNames()), key, version_cols, assume_unique)
    return _commit(rows, path, state, keep, share, layers, create)


def delete(keys: DataFrame, path: str, keep: int = KEEP, share: float = SHARE, layers: int = LAYERS) -> int:
    """Q-4: take the rows of ``keys`` (the table's key columns, and its version
    columns where it has any: a row of a later version stays) out of the table;
    returns the new version. Like an upsert it writes what it is sent, here
    tombstones; keys without a row do no harm."""
    spark = keys.sparkSession
    state = V.load(spark, path)
    if state is None or not state.key:
        return state.number if state else 0
    given = [*state.key, *state.order]
    rows = latest_per_key(keys.select(*given), state.key, state.order)
    based = [b for b, held in enumerate(state.layers) if held]  # elsewhere there is nothing to lay a tombstone on
    rows = rows.where(_place(state.key, len(state.layers)).isin(based))
    rows = rows.select(*[F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in state.struct().fields], F.lit(True).alias(GONE))
    return _commit(rows, path, state, keep, share, layers, create=False)


def _left(spark: SparkSession, path: str, state: Version, buckets: list[int]) -> DataFrame:
    """The rows of ``buckets`` below their last layer whose keys it does not have."""
    below = state.with_layers([old[:-1] if b in buckets else old for b, old in enumerate(state.layers)])
    sent = _read(spark, state.struct(), [V.bucket_path(path, state.layers[b][-1][0], b) for b in buckets])
    held, key = _resolved(spark, path, below, buckets), state.key
    keys = sent.select(*[F.col(k).alias(f"__u_{k}") for k in key])
    new = sum(state.layers[b][-1][1] for b in buckets)
    if new <= 0.5 * sum(layer[1] for b in buckets for layer in below.layers[b]):
        return held.join(keys, [held[k] == keys[f"__u_{k}"] for k in key], "left_anti")
    # most rows are replaced: only keys are shuffled to find the others
    stay = held.select(*[F.col(k).alias(f"__h_{k}") for k in key])
    stay, found = counted(stay.join(keys, [stay[f"__h_{k}"] == keys[f"__u_{k}"] for k in key], "left_anti"), "rows left")
    stay = checkpoint_frame(stay)
    stay = broadcast_few(stay, rows_of(found))
    return held.join(stay, [held[k].eqNullSafe(stay[f"__h_{k}"]) for k in key], "left_semi")


def _commit(rows: DataFrame, path: str, state: Version, keep: int, share: float, layers: int, create: bool) -> int:
    """Write ``rows`` (one per key) as the next version's changes and publish it."""
    spark, known = rows.sparkSession, state.number > 0
    state = replace(state, number=state.number + 1)
    folders, key = [V.new_folder(state.number)], state.key
    try:
        sent = _write(rows, path, folders[0], key, len(state.layers))
        if not sent and (known or not create):
            remove_path(spark, f"{path}/data/{folders[0]}")
            return state.number - 1
        state = state.with_layers([old + [[folders[0], sent[b], state.number]] if b in sent else old
                                   for b, old in enumerate(state.layers)])
        over = {b: sum(layer[1] for layer in state.layers[b][1:]) for b in sent}
        grown = [b for b in sent if over[b] > share * state.layers[b][0][1]]
        many = [b for b in sent if b not in grown and len(state.layers[b]) > layers + 1]
        if grown and not state.order and GONE not in rows.columns:
            total = _write(_left(spark, path, state, grown), path, folders[0], key, len(state.layers), "append")
            state = state.with_layers([[[folders[0], total[b], state.number]] if b in grown else old
                                       for b, old in enumerate(state.layers)])
            grown = []
        for chosen, find, below in ((grown, _resolved, 0), (many, _changes, 1)):
            if not chosen:
                continue
            folders.append(V.new_folder(state.number))
            made = _write(find(spark, path, state, chosen), path, folders[-1], key, len(state.layers))
            # a bucket that lost all its rows has no folder
            state = state.with_layers([old[:below] + [[folders[-1], made.get(b), state.number]] * (b in made) if b in chosen else old
                                       for b, old in enumerate(state.layers)])
        V.publish(spark, path, state)
    except BaseException:
        for folder in folders:  # of this attempt alone
            remove_path(spark, f"{path}/data/{folder}")
        raise
    merged = {*grown, *many}  # these buckets' changes are in a later folder of this version
    if len(merged) == len(sent):
        remove_path(spark, f"{path}/data/{folders[0]}")
    else:
        for b in sorted(merged):
            remove_path(spark, V.bucket_path(path, folders[0], b))
    V.expire(spark, path, keep)
    return state.number


def rebucket(spark: SparkSession, path: str, buckets: int, keep: int = KEEP) -> int:
    """Write the table anew in ``buckets`` buckets (a table grows; see README for
    how many); returns the new version."""
    state = V.load(spark, path)
    folder = V.new_folder(state.number + 1)
    try:
        made = _write(read_current(spark, path), path, folder, state.key, buckets)
        V.publish(spark, path, replace(state, number=state.number + 1, layers=[
            [[folder, made[b], state.number + 1]] if b in made else [] for b in range(buckets)]))
    except BaseException:
        remove_path(spark, f"{path}/data/{folder}")
        raise
    V.expire(spark, path, keep)
    return state.number + 1


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove the folders of attempts that crashed before their version was
    published; run it while nobody writes. Returns their names."""
    used = {layer[0] for n in V.numbers(spark, path) for layers in V.load(spark, path, n).layers for layer in layers}
    stray = [f for f in list_names(spark, f"{path}/data") if f.startswith("v=") and f not in used]
    for folder in stray:
        remove_path(spark, f"{path}/data/{folder}")
    return stray


# The document fields in the order the bulk source lists them.
BULK_SOURCE_FIELDS = ["actors", "actors_names", "description", "director", "genre", "id",
                      "imdb_rating", "title", "writers", "writers_names"]
JSON_OPTIONS = {"ignoreNullFields": "false"}


def bulk_records(docs: DataFrame, index: str, key: str = "id") -> DataFrame:
    """S-7: ``(id, action, source)``: the bulk action line naming index and
    document id, and the document itself, as JSON text."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"),
                                         F.col(key).alias("_id")).alias("index")),
                       JSON_OPTIONS)
    source = F.to_json(F.struct(*[F.col(c) for c in BULK_SOURCE_FIELDS]), JSON_OPTIONS)
    return docs.select(F.col(key).alias("id"), action.alias("action"), source.alias("source"))


def write_bulk(docs: DataFrame, path: str, index: str) -> None:
    """Newline-delimited bulk body: action line, then source line, per doc."""
    rec = bulk_records(docs, index)
    rec.select(F.concat_ws("\n", "action", "source").alias("value")).write.mode("overwrite").text(path)


Sink = Callable[[DataFrame], object]


def parquet_upsert_sink(path: str, key: str = "id", schema: T.StructType | None = None) -> Sink:
    """The upsert as a sink. It evaluates the documents once and ignores an empty
    input by itself, so the writer need not write them down for that."""
    def write(df: DataFrame) -> int | None:
        before = current_version(df.sparkSession, path)
        version = upsert(df, path, [key], schema=schema, create=False)
        return version if version != before else None
    write.once = True
    return write


def bulk_file_sink(path: str, index: str) -> Sink:
    return lambda df: write_bulk(df, path, index)


def index_sink(index: str, options: dict[str, str] | None = None, key: str = "id") -> Sink:
    """An external search index through its Spark connector (for example
    ``format("es")`` with ``es.mapping.id``). The connector jar is not part of
    this build, so this sink is untested here."""
    def write(df: DataFrame) -> None:
        (df.write.format("es").options(**{"es.mapping.id": key, **(options or {})})
         .mode("append").save(index))
    return write


def write_documents(df: DataFrame, sink: Sink) -> object | None:
    """S-8: hand documents to a sink; an empty input is a no-op. For a sink that
    does not say that it evaluates its input ``once``, the documents are written
    down first, so that the test and the sink do not compute them twice."""
    if getattr(sink, "once", False):
        return sink(df)
    df = checkpoint_frame(df)
    return None if df.isEmpty() else sink(df)
