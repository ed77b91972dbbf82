"""A change table as a stream whose offset is a position (R-1, R-3, P-4).

The file stream remembers which files it has read; a table whose files are
rewritten would be read again in full. Here the offset is ``(modified, id)`` of
the newest change read, kept in the query's checkpoint: a restart continues after
it, whatever files hold the rows then.

The newest position comes from the parquet footers (kept while a file stays as it
is) and from the rows of the row groups that reach it. A micro-batch reads the row
groups whose range of ``modified`` meets ``(start, end]``, each in one task of at
most about ``rows_per_task`` rows, batch by batch, and filters them by row.

Options: ``path`` (a folder or file; a local path or a store that pyarrow can
open), ``position`` and ``id`` (column names, ``modified`` and ``id``), ``after``
(ISO text without zone, or in UTC for zoned columns: only later changes, without
NULLs), ``until`` (the same: the stream ends there, ties included),
``rows_per_task``. Columns come from ``schema``; those a file lacks are NULL.

* Ties: rows with the same ``modified`` are ordered by ``id`` (NULL first), so a
  tie is never read twice; a row that joins the newest tie later is read if its id is
  greater. After ``after`` or ``until`` a tie counts as read.
* Without ``after`` the first batch also has the rows without ``modified`` (D-12);
  those that come later are no changes and are not read.
* An empty or absent folder gives no batch. Files and folders named with ``_`` or
  ``.`` are ignored; columns kept in folder names are not read.
* If the newest rows are removed, the position moves back to the newest left, and
  what changes after that is read (nothing is lost; keyed sinks take repeats).
* Files that are replaced while a batch runs fail the batch; a restart reads the new
  ones. Footers without ranges (INT96 times) make every batch read their rows' times.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

UNDATED = -(1 << 63)  # the position of a table that has no dated row
EPOCH = dt.datetime(1970, 1, 1)
BATCH = 1 << 16


def micros(text: str | None) -> int | None:
    """ISO text without zone (or with one) as microseconds since 1970."""
    if not text:
        return None
    at = dt.datetime.fromisoformat(text)
    if at.tzinfo is not None:
        at = at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (at - EPOCH) // dt.timedelta(microseconds=1)


@dataclass
class RowGroups(InputPartition):
    """Neighbouring row groups of a file, and the positions to read between."""
    path: str
    groups: list[int]
    start: dict
    end: dict

    def __init__(self, path: str, groups: list[int], start: dict, end: dict):
        super().__init__(0)
        self.path, self.groups, self.start, self.end = path, groups, start, end


def open_store(path: str):
    """pyarrow's file system for ``path``, and the path in it."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def times(column):
    """A column of times as microseconds since 1970."""
    import pyarrow as pa
    if pa.types.is_date(column.type):
        column = column.cast(pa.timestamp("us"))
    return column.cast(pa.timestamp("us", column.type.tz), safe=False).cast(pa.int64())


def within(at, ids, start: dict, end: dict):
    """Which rows lie in ``(start, end]``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def no_null(mask):
        return pc.fill_null(mask, False)

    if start["modified"] is None:
        after = pa.array([True] * len(at), pa.bool_())
    else:
        after = no_null(pc.greater(at, start["modified"]))
        if start["id"] is not None:
            tie = pc.and_(no_null(pc.equal(at, start["modified"])), no_null(pc.greater(ids, start["id"])))
            after = pc.or_(after, tie)
    upto = no_null(pc.less(at, end["modified"]))
    tie = no_null(pc.equal(at, end["modified"]))
    if end["id"] is not None:
        tie = pc.and_(tie, pc.fill_null(pc.less_equal(ids, end["id"]), True))
    upto = pc.or_(upto, tie)
    if start["modified"] is None:
        upto = pc.or_(upto, pc.is_null(at))
    return pc.and_(after, upto)


class PositionReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path = schema, options["path"]
        self.position, self.id = options.get("position", "modified"), options.get("id", "id")
        self.after, self.until = micros(options.get("after")), micros(options.get("until"))
        self.rows_per_task = int(options.get("rows_per_task", 1_000_000))
        self.footers: dict[str, tuple] = {}

    def initialOffset(self) -> dict:
        return {"modified": self.after, "id": None}

    def ranges(self) -> list[tuple[str, int, int, int | None, int | None]]:
        """(file, row group, rows, least, greatest time) of the table as it is;
        a range that the footer does not give is None."""
        import pyarrow.parquet as pq
        from pyarrow import fs
        store, root = open_store(self.path)
        info = store.get_file_info(root)
        files = [info] if info.type == fs.FileType.File else [
            f for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
            if f.type == fs.FileType.File and f.size
            and not any(p[:1] in "_." for p in f.path[len(root):].strip("/").split("/"))]
        now = {}
        for f in sorted(files, key=lambda f: f.path):
            stamp = (f.mtime_ns, f.size)
            known = self.footers.get(f.path)
            if known is None or known[0] != stamp:
                with store.open_input_file(f.path) as source:
                    known = stamp, self.footer(f.path, pq.ParquetFile(source))
            now[f.path] = known
        self.footers = now
        return [g for _, groups in now.values() for g in groups]

    def footer(self, path: str, file) -> list[tuple]:
        meta, kind = file.metadata, file.schema_arrow.field(self.position).type
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == self.position)
        per = {"ms": (1000, 1), "us": (1, 1), "ns": (1, 1000)}.get(getattr(kind, "unit", None))
        groups = []
        for g in range(meta.num_row_groups):
            group, least, greatest = meta.row_group(g), None, None
            stats = group.column(at).statistics
            if per and stats is not None and stats.has_min_max and isinstance(stats.min_raw, int):
                least, greatest = stats.min_raw * per[0] // per[1], -(-stats.max_raw * per[0] // per[1])
            # the rows without a time belong to the first batch alone
            groups.append((path, g, group.num_rows, least, greatest))
        return groups

    def latestOffset(self) -> dict:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        groups = self.ranges()
        if not groups:
            return self.initialOffset()
        dated = [g[4] for g in groups if g[4] is not None]
        top = max(dated, default=UNDATED)
        if self.until is not None and top > self.until:
            return {"modified": self.until, "id": None}
        best, greatest = UNDATED, None
        store, _ = open_store(self.path)
        for path, g, _, _, high in groups:
            if high is not None and high < top:
                continue
            with store.open_input_file(path) as source:
                for batch in pq.ParquetFile(source).iter_batches(BATCH, [g], [self.position, self.id]):
                    at, ids = times(batch.column(self.position)), batch.column(self.id)
                    here = pc.max(at).as_py()
                    if here is None or here < best:
                        continue
                    name = pc.max(ids.filter(pc.equal(at, here))).as_py()
                    if here > best:
                        best, greatest = here, name
                    elif name is not None and (greatest is None or name > greatest):
                        greatest = name
        if self.until is not None and best > self.until:
            best, greatest = self.until, None
        if self.after is not None and best <= self.after:
            return self.initialOffset()
        return {"modified": best, "id": greatest}

    def partitions(self, start: dict, end: dict) -> list[RowGroups]:
        parts, rows = [], 0
        first = start["modified"] is None
        for path, g, n, least, greatest in self.ranges():
            if not first and least is not None and (greatest < start["modified"] or least > end["modified"]):
                continue
            if parts and parts[-1].path == path and rows + n <= self.rows_per_task:
                parts[-1].groups.append(g)
                rows += n
            else:
                parts.append(RowGroups(path, [g], start, end))
                rows = n
        return parts

    def read(self, partition: RowGroups) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema
        wanted = to_arrow_schema(self.schema)
        store, _ = open_store(self.path)
        with store.open_input_file(partition.path) as source:
            file = pq.ParquetFile(source)
            has = set(file.schema_arrow.names)
            columns = sorted({*(c for c in wanted.names if c in has), self.position, self.id})
            for batch in file.iter_batches(BATCH, partition.groups, columns):
                batch = batch.filter(within(times(batch.column(self.position)), batch.column(self.id),
                                            partition.start, partition.end))
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(f.name).cast(f.type, safe=False) if f.name in has
                         else pa.nulls(batch.num_rows, f.type) for f in wanted], schema=wanted)

    def commit(self, end: dict) -> None:
        """Nothing to release: the checkpoint keeps the position."""


class PositionSource(DataSource):
    """``format("positions")``."""

    @classmethod
    def name(cls) -> str:
        return "positions"

    def streamReader(self, schema: StructType) -> PositionReader:
        return PositionReader(schema, dict(self.options))


def position_stream(spark: SparkSession, path: str, schema: StructType | str, **options: object) -> DataFrame:
    """The change table below ``path`` as a stream by position."""
    spark.dataSource.register(PositionSource)
    reader = spark.readStream.format("positions").schema(schema).option("path", path)
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return reader.load()
