"""SimHash near-duplicates with a Gray-order hierarchical index (operator 7).

**Fingerprints.** A text's words (ASCII letters lower-cased) give shingles,
repeats included; a bit of the 64-bit fingerprint is set if it is set in over
half of the shingles' hashes (XXH64, seed 42). Fewer words than a shingle: the
whole sequence is the only shingle. No words (or NULL): fingerprint zero, which
links like any other.

**Links.** Two fingerprints within ``BITS`` differing bits link; copies share a
fingerprint, so only different fingerprints are searched. Every fingerprint is
routed once by each of ``BITS + 1`` bit blocks: two that differ in at most
``BITS`` bits agree on a whole block and meet there. A meeting place sorts its
fingerprints by Gray rank, so that neighbours differ in few bits, and builds a
hierarchical index over them: a node holds the bits that all below it share
(mask and pattern). The index is joined with itself from the root: the shared
bits in which two nodes differ accumulate on the way down, beyond ``BITS`` the
whole pair of groups is pruned; if even all free bits could not exceed
``BITS``, the whole pair links at once; else the children are visited.

A place holding more than ``PLACE`` fingerprints is cut into blocks of
consecutive Gray ranks, and the pairs of blocks that their masks do not prune
go to tasks of their own, so neither a hot place's rows nor its work meet in
one task. A task returns at most a spanning forest of what it saw (a set of
links with the same components), never all pairs.

**Components** are found by repeated minimum labels over the links between
different fingerprints (``components``), cut by ``checkpoint()``.

Ids may repeat or be NULL; a component's id is its smallest non-NULL id (NULL
if it has none). Every input row gives one result row. Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .arrow import only, ship_package, with_columns
from .shared import checkpoint, components, stored

WORDS = 3      # words of a shingle
BITS = 3       # differing bits up to which fingerprints link
SEED = 42
PLACE = 4_096  # fingerprints that a task takes of one place, or of each of two blocks
LEAF = 64      # fingerprints of an index leaf
PIECE = 1 << 16    # shingles hashed at once
QUANTILES = 1_000  # blocks that a place is cut into, at most


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    parts = (text or "").encode("utf-8").lower().split()  # bytes: ASCII letters and space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    after = np.cumsum([len(p) + 1 for p in parts])  # where the word after each begins
    starts, ends = np.append(0, after[:-words]), after[min(words, len(parts)) - 1:] - 1
    if len(parts) < words:
        starts = starts[:1]
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(ends), PIECE):  # bounded memory for very long texts
        spans = zip(starts[at:at + PIECE].tolist(), ends[at:at + PIECE].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype=">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: ``id`` and ``fp``, the fingerprint's bits as
    a signed long."""

    def factory():
        def work(batch):
            made = np.array([fingerprint(t, words) for t in batch.column(text).to_pylist()], np.uint64)
            return [pa.array(made.view(np.int64))]

        return work

    return with_columns(only(docs, id, text), factory, [StructField("fp", LongType())], drop=[text])


def gray_rank(fp: F.Column) -> F.Column:
    """The place of a code in Gray order: each bit is the parity of those above."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _blocks(bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the ``bits + 1`` blocks that cover 64 bits."""
    cuts = [64 * i // (bits + 1) for i in range(bits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


class GrayIndex:
    """A hierarchy over fingerprints in Gray order.

    ``levels[0]`` describes leaves of ``LEAF`` fingerprints, each further level
    pairs of nodes below. A node's ``mask`` marks the bits all of its
    fingerprints share and ``pattern`` holds them.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        first = np.arange(0, len(codes), LEAF)
        low, high = np.bitwise_and.reduceat(codes, first), np.bitwise_or.reduceat(codes, first)
        self.levels = [(~(low ^ high), low)]
        while len(low) > 1:
            pairs = np.arange(0, len(low), 2)
            low, high = np.bitwise_and.reduceat(low, pairs), np.bitwise_or.reduceat(high, pairs)
            self.levels.append((~(low ^ high), low))

    def leaf(self, node: int) -> tuple[int, int]:
        return node * LEAF, min(len(self.codes), (node + 1) * LEAF)

    def span(self, level: int, node: int) -> tuple[int, int]:
        size = LEAF << level
        return node * size, min(len(self.codes), (node + 1) * size)


class Forest:
    """Union-find over positions; a tree's root is its smallest one."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def link(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def join_indexes(a: GrayIndex, b: GrayIndex, shift: int, forest: Forest, bits: int) -> None:
    """Link the positions of ``a`` and ``b`` (those of ``b`` are offset by
    ``shift``) that lie within ``bits`` bits; ``a`` may be ``b`` itself."""
    same = a is b
    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        la, i, lb, j = todo.pop()
        (mask_a, low_a), (mask_b, low_b) = a.levels[la], b.levels[lb]
        shared = int(mask_a[i] & mask_b[j])
        apart = ((int(low_a[i]) ^ int(low_b[j])) & shared).bit_count()
        if apart > bits:
            continue  # the groups differ too much in what they share
        if apart + 64 - shared.bit_count() <= bits:  # no two of them can differ more
            (s, e), (t, u) = a.span(la, i), b.span(lb, j)
            for x in range(s, e):
                forest.link(x, shift + t)
            for y in range(t + 1, u):
                forest.link(s, shift + y)
        elif la == 0 and lb == 0:
            (s, e), (t, u) = a.leaf(i), b.leaf(j)
            near = np.bitwise_count(a.codes[s:e, None] ^ b.codes[None, t:u]) <= bits
            if same and i == j:
                near = np.triu(near, 1)
            for x, y in zip(*(k.tolist() for k in np.nonzero(near))):
                forest.link(s + x, shift + t + y)
        else:
            kids = lambda index, level, n: ([(0, n)] if level == 0 else
                                            [(level - 1, k) for k in (2 * n, 2 * n + 1)
                                             if k < len(index.levels[level - 1][0])])
            if same and (la, i) == (lb, j):
                below = kids(a, la, i)
                todo += [(*x, *y) for n, x in enumerate(below) for y in below[n:]]
            elif la >= lb:
                todo += [(*x, lb, j) for x in kids(a, la, i)]
            else:
                todo += [(la, i, *y) for y in kids(b, lb, j)]


def spanning_links(codes: np.ndarray, split: int | None, bits: int) -> list[tuple[int, int]]:
    """Positions (root, member) of the trees that the links among ``codes`` (Gray
    order) form, or with ``split`` those between the two sides of that position."""
    forest = Forest(len(codes))
    if split is None:
        if len(codes) <= 8:  # most places: a few rows need no index
            near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= bits
            for x, y in zip(*(k.tolist() for k in np.nonzero(np.triu(near, 1)))):
                forest.link(x, y)
        else:
            index = GrayIndex(codes)
            join_indexes(index, index, 0, forest, bits)
    elif 0 < split < len(codes):
        join_indexes(GrayIndex(codes[:split]), GrayIndex(codes[split:]), split, forest, bits)
    return [(root, x) for x in range(len(codes)) if (root := forest.find(x)) != x]


LINK = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _search(places: DataFrame, bits: int) -> DataFrame:
    """Links found in each place. ``places`` has ``place`` (any key), ``part`` (0
    or 1; all 0 in a place joined with itself) and ``fp``; a place's rows are
    brought together and sorted by part and Gray rank."""
    ship_package(places)
    together = (places.withColumn("gray", gray_rank(F.col("fp")))
                .repartition("place").sortWithinPartitions("place", "part", "gray")
                .select("place", "part", "fp"))

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        current = None

        def finish():
            codes = np.concatenate([c for c, _ in held])
            parts = np.concatenate([p for _, p in held])
            if len(codes) < 2:
                return None
            split = int(np.searchsorted(parts, 1)) if parts[-1] else None
            return [(codes[x], codes[y]) for x, y in spanning_links(codes, split, bits)]

        def batch_of(links):
            pair = np.array(links, np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], schema=ARROW)

        ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        ready: list = []
        for batch in batches:
            place = batch.column("place").to_numpy(zero_copy_only=False)
            codes = batch.column("fp").to_numpy().view(np.uint64)
            parts = batch.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), len(place)]
            for s, e in zip(cuts, cuts[1:]):
                if held and place[s] != current:
                    ready += finish() or ()
                    held = []
                current = place[s]
                held.append((codes[s:e], parts[s:e]))
            if len(ready) >= 10_000:
                yield batch_of(ready)
                ready = []
        if held:
            ready += finish() or ()
        if ready:
            yield batch_of(ready)

    return together.mapInArrow(run, LINK)


def links(distinct: DataFrame, bits: int = BITS, place_rows: int = PLACE) -> DataFrame:
    """Links (``a``, ``b``) whose components are those of all pairs of different
    fingerprints of ``distinct`` (``fp``, no repeats) within ``bits`` bits."""
    routed = distinct.select("fp", F.posexplode(F.array(*[
        F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in _blocks(bits)]))
        .alias("block", "value")).select("fp", (F.col("value") * 64 + F.col("block")).alias("place"))
    large = checkpoint(routed.groupBy("place").count().where(F.col("count") > place_rows))
    ordinary = routed.join(large, "place", "left_anti")
    here = _search(ordinary.select("place", F.lit(0).alias("part"), "fp"), bits)
    return here.unionByName(_hot_links(routed.join(large, "place"), bits, place_rows))


def _hot_links(hot: DataFrame, bits: int, place_rows: int) -> DataFrame:
    """Links within places of more rows than one task should take.

    ``hot`` has ``place``, ``count`` and ``fp``. The rows are cut into blocks at
    estimated Gray quantiles; a block is described by the bits it shares, and
    block pairs that these do not prune are joined, each in a place of its own.
    """
    ranked = hot.withColumn("gray", gray_rank(F.col("fp")).bitwiseXOR(F.lit(-(1 << 63))))
    cuts = ranked.groupBy("place").agg(
        F.percentile_approx("gray", [i / QUANTILES for i in range(1, QUANTILES)], 10_000).alias("cuts"),
        F.max("count").alias("n"))
    # every step-th quantile is a cut, so that a block has about place_rows / 2 rows
    # (written once: estimates differ from run to run, and nodes and search must see the same blocks)
    cuts = stored(cuts.select("place", F.filter("cuts", lambda x, i: (i + 1) % F.greatest(
        F.lit(1), F.floor(F.lit(QUANTILES / 2 * place_rows) / F.col("n"))) == 0).alias("cuts")))
    blocks = ranked.join(cuts, "place").select(
        "place", "fp", F.size(F.filter("cuts", lambda c: c < F.col("gray"))).alias("block"))
    nodes = blocks.groupBy("place", "block").agg(F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high"))
    nodes = checkpoint(nodes.withColumn("mask", F.bitwise_not(F.col("low").bitwiseXOR(F.col("high")))))
    x, y = nodes.alias("x"), nodes.alias("y")
    apart = F.bit_count(F.col("x.low").bitwiseXOR(F.col("y.low"))
                        .bitwiseAND(F.col("x.mask")).bitwiseAND(F.col("y.mask")))
    pairs = x.join(y, (F.col("x.place") == F.col("y.place")) & (F.col("x.block") <= F.col("y.block"))
                   & (apart <= bits)).select(
        F.col("x.place").alias("place"), F.col("x.block").alias("left"), F.col("y.block").alias("right"))
    sides = pairs.select("place", "left", "right", F.explode(F.when(
        F.col("left") == F.col("right"), F.array(F.struct(F.col("left").alias("block"), F.lit(0).alias("part")))
    ).otherwise(F.array(F.struct(F.col("left").alias("block"), F.lit(0).alias("part")),
                        F.struct(F.col("right").alias("block"), F.lit(1).alias("part"))))).alias("s"))
    sides = sides.select("place", F.col("s.block").alias("block"), F.col("s.part").alias("part"),
                         ((F.col("place") * QUANTILES + F.col("left")) * QUANTILES + F.col("right")).alias("pair"))
    joined = blocks.join(sides, ["place", "block"]).select(F.col("pair").alias("place"), "part", "fp")
    return _search(joined, bits)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                    words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``fp`` and ``component_id``."""
    marked = checkpoint(fingerprints(docs, id, text, words))
    distinct = checkpoint(marked.groupBy("fp").agg(F.min(id).alias("least")))
    group = components(links(distinct.select("fp"), bits), distinct)
    return marked.join(group, "fp").select(id, "fp", "component_id")


ROW = "_simhash_row"


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text",
             words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The row of the smallest id of each group (NULL after all others), all
    columns; of rows that share it, the first one read. The rows are written
    with their numbers, as a second reading may number them otherwise."""
    rows = stored(docs.withColumn(ROW, F.monotonically_increasing_id()))
    keyed = rows.select(F.struct(F.col(id).isNull().alias("unknown"), F.col(id).alias("id"), F.col(ROW).alias("row")).alias("_key"),
                        F.col(text).alias("text"))
    groups = near_duplicates(keyed, "_key", "text", words, bits)
    kept = checkpoint(groups.where("_key = component_id").select(F.col("_key.row").alias(ROW)))
    return rows.join(kept, ROW, "left_semi").drop(ROW)
