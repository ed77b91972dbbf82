"""Per-row helpers that run inside Spark tasks on Arrow batches.

The operators of this subpackage that need Python do so here: Spark splits
the table, every task streams its Arrow batches through a function, and the
function adds columns to the rows it was given. Nothing is gathered.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Rows and bytes handed to the Python function at once: bounds a worker's
#: memory when texts are long, whatever the session's Arrow batch size is. (A
#: longer row is handed over alone.)
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship_package(df: DataFrame) -> None:
    """Let Python workers import this package from where the driver did."""
    env = df.sparkSession.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT in sys.path and _ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, known)])


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS):
    """The batch in slices of bounded rows and bytes."""
    if batch.num_rows > rows or (batch.num_rows > 1 and batch.nbytes > SLICE_BYTES):
        half = min(rows, -(-batch.num_rows // 2))
        yield from slices(batch.slice(0, half), rows)
        yield from slices(batch.slice(half), rows)
    elif batch.num_rows:
        yield batch


def with_columns(
    df: DataFrame,
    factory: Callable[[], Callable[[pa.RecordBatch], Iterable]],
    fields: Sequence[StructField],
    drop: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``df`` plus ``fields``, computed batch by batch.

    ``factory()`` runs once per task and returns a function from a record
    batch (all of ``df``'s columns) to one Arrow array or Python list per
    field. ``drop`` names input columns that the result does without. An input
    column whose name clashes with a field is replaced by it (names compare
    without case, as Spark does).
    """
    ship_package(df)
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields
            if f.name.lower() not in new | {d.lower() for d in drop}]
    schema = StructType([*kept, *fields])
    names = [f.name for f in kept]
    out_names = [f.name for f in schema.fields]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        types = [to_arrow_type(f.dataType) for f in fields]
        work = factory()
        for whole in batches:
            for batch in slices(whole, slice_rows):
                made = work(batch)
                added = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=t)
                         for c, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in names] + added, names=out_names)

    return df.mapInArrow(run, schema)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns; a missing one reads as NULL strings."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(f"`{have[n.lower()]}`").alias(n) if n.lower() in have
                       else F.lit(None).cast("string").alias(n) for n in names])


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; NULL reads as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]
