"""A-9: row counts of a batch, taken while the batch is processed.

``df.observe`` attaches a named metric to whatever action runs next, so the
count costs no extra pass over the data (the reference logs ``len`` of each
fetched batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def rows_of(obs: Observation) -> int:
    """The count after the action ran (blocks until the metric arrives)."""
    return int(obs.get.get("rows", 0))


#: Rows of keys that are broadcast by their known number. A planner does not know
#: the size of a written frame, and would shuffle the large side of a join.
FEW = 500_000


def broadcast_few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, marked for a broadcast where its number of ``rows`` is small."""
    return F.broadcast(df) if rows <= FEW else df
