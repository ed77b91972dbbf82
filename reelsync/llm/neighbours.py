"""Approximate nearest neighbours by multi-index hashing (operator 9).

**Codes.** Vectors are centred, rotated and cut to sign bits. The rotations are
learned on a bounded sample (about ``SAMPLE`` different vectors chosen by their
hash, however often one repeats) by iterative quantization, which turns the principal axes so that taking
signs loses least; several of them make up ``CODE_BITS`` bits. A row's code
needs only these matrices, so every row is indexed.

**Index.** Rows are dealt by a hash into blocks of about ``BLOCK`` rows, and
queries into groups of about ``GROUP``. In a block a code is split into
substrings of 16 bits, and each substring has a table from values to rows.
Two codes that differ in at most ``s * (r + 1) - 1`` bits (s substrings) differ
in at most r bits of some substring, so probing all values within r bits of the
query's substrings finds every code of the block within that radius.

**Search.** In each block a query's radius grows until it holds ``SHARE`` of the
block's rows (``LEAST`` at least); all codes within the radius are reranked by
exact Euclidean distance in double precision and the block's ``k`` best go on.
A last step keeps each query's ``k`` best of all blocks, ties to the smaller id.
No bucket, probe or candidate set is capped.

Equal vectors are one entry with its ids; only its ``k + 1`` smallest ids can be
among any query's nearest, so an entry keeps those (combined inside each task
first) and a very frequent vector is one candidate, not many.

Vectors that are NULL, zero, or hold NULL or non-finite components take no part,
as do those with a NULL id or a length other than the most frequent one (the
smaller one at a tie). A row repeated with its id counts once; an id with several
vectors is a query for each and its rows are not its own candidates. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from .arrow import ship_package
from .shared import checkpoint

SAMPLE = 4_096
ITERATIONS = 30
CODE_BITS = 256
BLOCK = 4_096    # different vectors of an index block, about
GROUP = 4_096    # queries of a group, about
SHARE = 0.05     # of a block's rows that a search takes in
LEAST = 100
MASKS = [np.array([m for m in range(1 << 16) if m.bit_count() <= r], np.uint16) for r in range(2)]


class Codes:
    """Mean and rotations learned from a sample; turns vectors into bits."""

    def __init__(self, sample: np.ndarray, bits: int = CODE_BITS):
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        _, _, axes = np.linalg.svd(centred, full_matrices=False)
        draw = np.random.default_rng(9)
        turns, width = [], min(axes.shape[0], bits)
        projected = centred @ axes[:width].T
        for _ in range(-(-bits // width)):
            turn, _ = np.linalg.qr(draw.normal(size=(width, width)))
            for _ in range(ITERATIONS):
                u, _, v = np.linalg.svd(np.sign(projected @ turn).T @ projected)
                turn = (u @ v).T
            turns.append(axes[:width].T @ turn)
        self.turn = np.hstack(turns)[:, :bits]

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """The 16-bit substrings of each vector's code, one row per vector."""
        packed = np.packbits((vectors - self.mean) @ self.turn > 0, axis=1)
        return np.ascontiguousarray(packed).view(np.uint16)


class BlockIndex:
    """The substring tables of one block's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []  # per substring: its values, their rows, and each row's value
        for part in codes.T:
            values, place = np.unique(part, return_inverse=True)
            order = np.argsort(place, kind="stable")
            self.tables.append((values, np.searchsorted(place[order], np.arange(len(values) + 1)), order, place))

    def probed(self, query: np.ndarray, distance: int) -> np.ndarray:
        """Rows of which some substring is within ``distance`` bits of the
        query's, by looking up every such value."""
        hits = []
        for own, (values, first, order, _) in zip(query, self.tables):
            wanted = own ^ MASKS[distance]
            at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
            hits += [order[first[i]:first[i + 1]] for i in at[values[at] == wanted]]
        return np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int64)

    def nearest_part(self, query: np.ndarray) -> np.ndarray:
        """Each row's least distance of a substring: every table's values are
        compared once, the rows take their value's distance."""
        best = np.full(len(self.codes), 16, np.uint8)
        for own, (values, _, _, place) in zip(query, self.tables):
            np.minimum(best, np.bitwise_count(values ^ own)[place], out=best)
        return best

    def near(self, query: np.ndarray, distance: int) -> np.ndarray:
        """Rows of which some substring is within ``distance`` bits of the
        query's. Beyond a few bits there are more values to look up than a
        block has rows, and the tables' own values are compared."""
        if distance < len(MASKS):
            return self.probed(query, distance)
        return np.flatnonzero(self.nearest_part(query) <= distance)

    def within(self, query: np.ndarray, enough: int) -> np.ndarray:
        """All rows within the first radius that holds ``enough`` rows."""
        parts, best = self.codes.shape[1], None
        for distance in range(17):
            if distance < len(MASKS):
                rows = self.probed(query, distance)
            else:
                best = self.nearest_part(query) if best is None else best
                rows = np.flatnonzero(best <= distance)
            if len(rows) < enough:
                continue
            apart = np.bitwise_count(self.codes[rows] ^ query).sum(axis=1, dtype=np.int64)
            inside = rows[apart <= parts * (distance + 1) - 1]
            if len(inside) >= enough:
                return inside
        return np.arange(len(self.codes))


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (array of double) of the rows that may take part."""
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))


def learn(rows: DataFrame, n: int, sample: int = SAMPLE, bits: int = CODE_BITS) -> Codes:
    """Codes from about ``sample`` of the ``n`` different vectors in ``rows``,
    chosen by their hash."""
    share = min(1 << 20, -(-sample * (1 << 20) // n))
    chosen = rows.where(F.pmod(F.xxhash64("v", F.lit(9)), F.lit(1 << 20)) < share).select("v").collect()
    chosen = chosen or rows.select("v").limit(1).collect()
    return Codes(np.array([r.v for r in chosen]), bits)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) + 0.0


def entries(rows: DataFrame, k: int) -> DataFrame:
    """One row per different vector: ``v`` and its ``k + 1`` smallest ``ids``.
    Each task combines its own rows before they move."""
    ship_package(rows)
    keep = k + 1
    schema = StructType([StructField("v", ArrayType(DoubleType())), StructField("ids", ArrayType(LongType()))])

    def combine(batches):
        held: dict[bytes, set] = {}

        def flush():
            flat = [np.frombuffer(b, np.float64) for b in held]
            batch = pa.RecordBatch.from_arrays([
                pa.array(flat, pa.list_(pa.float64())),
                pa.array([sorted(ids)[:keep] for ids in held.values()], pa.list_(pa.int64()))], names=["v", "ids"])
            held.clear()
            return batch

        for batch in batches:
            for id_, row in zip(batch.column("id").to_pylist(), _matrix(batch.column("v"))):
                ids = held.setdefault(row.tobytes(), set())
                ids.add(id_)
                if len(ids) > 4 * keep:
                    held[row.tobytes()] = set(sorted(ids)[:keep])
            if len(held) >= 20_000:
                yield flush()
        if held:
            yield flush()

    combined = rows.mapInArrow(combine, schema)
    return combined.groupBy("v").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))


RESULT = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()),
                     StructField("score", DoubleType()), StructField("query", LongType())])


def nearest(vectors: DataFrame, queries: F.Column, id: str = "vec_id", vector: str = "embedding",
            k: int = 10, share: float = SHARE, least: int = LEAST, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """The ``k`` nearest rows of each row that ``queries`` selects: ``query_id``,
    ``rank`` (from 1), ``vec_id``, ``score`` (the distance)."""
    spark = vectors.sparkSession
    rows = usable(vectors, id, vector)
    size = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == size["width"])
    index = checkpoint(entries(rows, k))
    different = index.count()
    codes = spark.sparkContext.broadcast(learn(index, different))  # a few matrices
    asked = usable(vectors.where(queries), id, vector).where(F.size("v") == size["width"]).dropDuplicates()
    asked = checkpoint(asked.withColumn("query", F.monotonically_increasing_id()))
    blocks = -(-different // block)
    groups = max(1, -(-asked.count() // group))
    deal = lambda key, n, seed: F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.withColumn("block", deal("v", blocks, 1)).withColumn("group", every(groups))
    right = asked.withColumn("group", deal("query", groups, 2)).withColumn("block", every(blocks))

    def search(table: pa.Table, asked: pa.Table) -> pa.Table:
        found: dict[str, list] = {f.name: [] for f in RESULT.fields}
        if table.num_rows and asked.num_rows:
            v, ids = _matrix(table.column("v")), table.column("ids").to_pylist()
            blocked = BlockIndex(codes.value.encode(v))
            w = _matrix(asked.column("v"))
            enough = min(len(v), max(least, int(np.ceil(share * len(v)))))
            for own, query, vector_, code in zip(asked.column("id").to_pylist(), asked.column("query").to_pylist(),
                                                 w, codes.value.encode(w)):
                near = blocked.within(code, enough)
                apart = v[near] - vector_
                score = np.sqrt((apart * apart).sum(axis=1))
                # k + 1 entries hold k other rows even if the query's own is one of them
                best = np.flatnonzero(score <= np.partition(score, min(k, len(score) - 1))[min(k, len(score) - 1)])
                pairs = sorted((score[i], x) for i in best for x in ids[near[i]] if x != own)[:k]
                found["query_id"] += [own] * len(pairs)
                found["vec_id"] += [x for _, x in pairs]
                found["score"] += [float(s) for s, _ in pairs]
                found["query"] += [query] * len(pairs)
        return pa.table({f.name: pa.array(found[f.name], pa.float64() if f.name == "score" else pa.int64())
                         for f in RESULT.fields})

    per_block = (left.groupBy("block", "group").cogroup(right.groupBy("block", "group"))
                 .applyInArrow(search, RESULT))
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return (per_block.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
