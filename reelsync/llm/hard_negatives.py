"""Hard negatives by a vertical scan with bounds (operator 11).

Components are integers, ``floor(scale * x)``, and a row's score is its inner
product with the anchor. Rows are dealt into blocks that keep their vectors as
columns, one per dimension, sorted by label. An anchor reads a block's columns
in the order of its own descending magnitudes and adds them to its candidates'
partial scores. What the unread columns can still add lies between the sums of
their least and greatest contributions (from each column's minimum and maximum),
so every candidate has a score interval, and after each step the candidates'
bitmap loses those that cannot count any more:

* positives: rows of the anchor's label whose greatest score is below the
  ``k``-th least one;
* negatives: rows of other labels whose interval meets no positive's window
  ``[ratio * positive, positive]``, or lies below the ``k``-th best that is
  certain to be inside it.

When all columns are read the scores are exact. Each block returns ``k`` rows
per anchor (and window); a last step keeps the ``k`` best of all blocks. Nothing
is approximate or capped: ties at the cut are settled by the smaller id.

Scores are added in doubles while every sum fits 53 bits, else in Python's
integers; a score that does not fit a long is NULL in the result (it still
ranks). Rows with a NULL id, label or vector, or with a NULL or non-finite
component, or one of 2^52 or more when scaled, take no part, as do those of a
length other than the most frequent one (the smaller at a tie). A row repeated with its label and vector counts once,
as anchor and as candidate; an id's rows are never candidates of their own id's
anchors. Zero vectors take part. Columns other than these three are ignored; an
empty table gives no rows.

Anchors meet every block, in groups of ``GROUP``: the work is anchors times
rows, less what the bounds save.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .arrow import ship_package
from .shared import checkpoint

BLOCK = 8_192    # rows of a block, about
GROUP = 16_384   # anchors of a group, about
STEP = 8         # columns read between two looks at the bitmap
CELLS = 1 << 22  # components of a block or group, where vectors are long
EXACT = 1 << 53
LARGEST = float(1 << 52)  # of a scaled component


class Columns:
    """A block's vectors by dimension, rows sorted by label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def bounds(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The order of the columns, and what those from each place on can add
        at least and at most."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.array([anchor[order] * self.low[order], anchor[order] * self.high[order]])
        rest = lambda x: np.append(np.cumsum(x[::-1])[::-1], 0)
        return order, rest(ends.min(axis=0)), rest(ends.max(axis=0))

    def scan(self, anchor: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """The rows that ``keep(least, greatest)`` leaves in the bitmap, with
        their exact scores."""
        order, least, most = self.bounds(anchor)
        scores = np.zeros(len(rows), self.columns.dtype)
        for first in range(0, len(order), STEP):
            read = order[first:first + STEP]
            if len(rows) == self.columns.shape[1]:
                scores = scores + anchor[read] @ self.columns[read]
            else:
                scores = scores + anchor[read] @ self.columns[np.ix_(read, rows)]
            after = min(first + STEP, len(order))
            alive = keep(scores + least[after], scores + most[after])
            rows, scores = rows[alive], scores[alive]
            if not len(rows):
                break
        return rows, scores

    def positives(self, anchor: np.ndarray, id: int, label: int, k: int) -> list[tuple[int, int]]:
        """``(score, id)`` of the ``k`` best rows of the label, best first."""
        rows = np.arange(*(np.searchsorted(self.labels, label, side) for side in ("left", "right")))
        rows = rows[self.ids[rows] != id]

        def keep(low, high):
            return high >= np.partition(low, -k)[-k] if len(low) > k else np.ones(len(low), bool)

        return _best(*self.scan(anchor, rows, keep), self.ids, k)

    def negatives(self, anchor: np.ndarray, id: int, label: int, windows: list[tuple[int, int]],
                  k: int) -> list[list[tuple[int, int]]]:
        """Per window ``(least, greatest)``: ``(score, id)`` of the ``k`` best
        rows of other labels inside it, best first."""
        rows = np.flatnonzero((self.labels != label) & (self.ids != id))

        def keep(low, high):
            alive = np.zeros(len(low), bool)
            for least, most in windows:
                sure = low[(low >= least) & (high <= most)]
                floor = max(least, np.partition(sure, -k)[-k]) if len(sure) >= k else least
                alive |= (high >= floor) & (low <= most)
            return alive

        rows, scores = self.scan(anchor, rows, keep)
        inside = [(scores >= least) & (scores <= most) for least, most in windows]
        return [_best(rows[i], scores[i], self.ids, k) for i in inside]


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    if len(rows) > k:
        near = scores >= np.partition(scores, -k)[-k]
        rows, scores = rows[near], scores[near]
    return sorted(((int(s), int(i)) for s, i in zip(scores, ids[rows])), key=lambda x: (-x[0], x[1]))[:k]


def _vectors(table: pa.Table, name: str) -> np.ndarray:
    flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def _numbers(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if every sum of products is exact in them, else as objects."""
    size = lambda x: int(np.abs(x).max(initial=0))
    if size(rows) * size(anchors) * max(1, rows.shape[1]) < EXACT:
        return rows, anchors
    whole = lambda x: np.array([[int(c) for c in row] for row in x], object).reshape(x.shape)
    return whole(rows), whole(anchors)


def usable(vectors: DataFrame, asked: Column, id: str, vector: str, label: str | Column, scale: float) -> DataFrame:
    """``id``, ``label``, ``v`` (integers held as doubles) and ``asked`` (whether
    it is an anchor) of the rows that may take part, each different row once."""
    label = F.col(label) if isinstance(label, str) else label
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * scale)
    rows = vectors.select(F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), scaled.alias("v"),
                          F.coalesce(asked, F.lit(False)).alias("asked"))
    held = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & held)
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x).cast("double")))
    return rows.groupBy("id", "label", "v").agg(F.max("asked").alias("asked"))


FOUND = StructType([StructField("anchor", LongType()), StructField("window", LongType()), StructField("score", StringType()),
                    StructField("id", LongType())])


def mine(vectors: DataFrame, asked: Column, id: str = "vec_id", vector: str = "embedding",
         label: str | Column = "label", scale: float = 256.0, positives: int = 5, negatives: int = 5,
         ratio: tuple[int, int] = (80, 100), block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """For each row that the condition ``asked`` selects and each of its
    ``positives`` best rows of its label, the ``negatives`` best rows of other
    labels with ``ratio[0] * positive <= ratio[1] * score <= ratio[1] * positive``:
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``."""
    ship_package(vectors)
    least_of = lambda p: -(-ratio[0] * p // ratio[1])
    rows = usable(vectors, asked, id, vector, label, scale)
    rows = checkpoint(rows.withColumn("row", F.monotonically_increasing_id()))
    size = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("rows"), F.count_if("asked").alias("anchors"))
    size = size.orderBy(F.desc("rows"), "width").first()
    if size is None:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                        "positive_score long, negative_score long")
    rows = rows.where(F.size("v") == size["width"])
    anchors = rows.where("asked").select(*[F.col(c).alias(n) for c, n in (
        ("row", "anchor"), ("id", "anchor_id"), ("label", "anchor_label"), ("v", "q"))])
    most = max(1, CELLS // max(1, size["width"]))
    blocks, groups = -(-size["rows"] // min(block, most)), max(1, -(-size["anchors"] // min(group, most)))
    deal = lambda key, n, seed: F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = rows.select("row", "id", "label", "v").withColumn("block", deal("row", blocks, 1)).withColumn("group", every(groups)).groupBy("block", "group")

    def per_block(anchors: DataFrame, find) -> DataFrame:
        """``find(columns, vector, anchor)`` gives a list of rows per window."""
        sent = anchors.withColumn("group", deal("anchor", groups, 2)).withColumn("block", every(blocks))

        def search(table: pa.Table, asked: pa.Table) -> pa.Table:
            out = []
            if table.num_rows and asked.num_rows:
                whole, queries = _numbers(_vectors(table, "v"), _vectors(asked, "q"))
                columns = Columns(table.column("id").to_numpy(), table.column("label").to_numpy(), whole)
                for row, q in zip(asked.drop_columns("q").to_pylist(), queries):
                    for window, found in find(columns, q, row):
                        out += [(row["anchor"], window, str(s), i) for s, i in found]
            made = list(zip(*out)) or [[]] * 4
            return pa.table({f.name: pa.array(c, pa.string() if f.name == "score" else pa.int64())
                             for f, c in zip(FOUND.fields, made)})

        return stored.cogroup(sent.groupBy("block", "group")).applyInArrow(search, FOUND)

    def best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        score = F.col("score").cast("decimal(38,0)")
        order = Window.partitionBy(*keys).orderBy(score.desc(), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def find_positives(columns, q, row):
        return [(0, columns.positives(q, row["anchor_id"], row["anchor_label"], positives))]

    first = checkpoint(best(per_block(anchors, find_positives), ["anchor"], positives)
                       .select("anchor", F.col("rank").alias("window"), F.col("id").alias("positive"), F.col("score").alias("positive_score")))
    windows = first.groupBy("anchor").agg(F.collect_list(F.struct("window", "positive_score")).alias("windows"))

    def find_negatives(columns, q, row):
        scores = [int(w["positive_score"]) for w in row["windows"]]
        found = columns.negatives(q, row["anchor_id"], row["anchor_label"], [(least_of(p), p) for p in scores], negatives)
        return zip([w["window"] for w in row["windows"]], found)

    second = best(per_block(anchors.join(windows, "anchor"), find_negatives), ["anchor", "window"], negatives)
    names = anchors.select("anchor", "anchor_id")
    long = lambda c: F.col(c).try_cast("long").alias(c)
    return (second.select("anchor", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(first, ["anchor", "window"]).join(names, "anchor")
            .select("anchor_id", F.col("positive").alias("positive_id"), "rank", "negative_id", long("positive_score"),
                    long("negative_score")))



#: The mining of ``embeddings`` with the query's parameters as DuckDB SQL.
MINE_SQL = """WITH rows AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, r.id, r.label = a.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.id <> r.id WHERE a.id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5"""
