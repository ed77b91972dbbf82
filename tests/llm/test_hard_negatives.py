"""Operator 11: against brute force, bounds, ties, big numbers and edge rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from reelsync.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchor, k=5, m=5, scale=256.0):
    """Sorted result tuples; ``rows`` are (id, vector, label)."""
    whole = {(i, l, tuple(math.floor(scale * x) for x in v)) for i, v, l in rows}
    out = []
    for i, l, v in whole:
        if not anchor(i):
            continue
        scored = sorted(((sum(a * b for a, b in zip(v, w)), j, n) for j, n, w in whole if j != i), key=lambda x: (-x[0], x[1]))
        for p, pid, _ in [s for s in scored if s[2] == l][:k]:
            inside = [s for s in scored if s[2] != l and 80 * p <= 100 * s[0] <= 100 * p][:m]
            out += [(i, pid, r, nid, p, n) for r, (n, nid, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(vectors, anchor, **kw):
    return sorted(tuple(r[c] for c in COLUMNS) for r in H.mine(vectors, anchor, **kw).collect())


def test_against_brute_force_over_blocks_and_groups(spark):
    draw = np.random.default_rng(1)
    base = draw.normal(size=(6, 12))
    rows = [(i, [float(x) for x in base[i % 6] + draw.normal(size=12) * 0.8], i * 7 % 4) for i in range(400)]
    want = brute(rows, lambda i: i % 20 == 0)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert want and mined(vectors, F.col("vec_id") % 20 == 0) == want
    assert mined(vectors, F.col("vec_id") % 20 == 0, block=60, group=7) == want


def test_ties_and_frequent_vectors(spark):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(200)] + [(500 + i, [0.9, 0.5], 1) for i in range(9)]
    vectors = spark.createDataFrame(rows + rows[:50], SCHEMA).repartition(4)  # repeated rows count once
    assert mined(vectors, F.col("vec_id").isin(0, 7), block=40) == brute(rows, lambda i: i in (0, 7))


def test_big_components_stay_exact(spark):
    rows = [(i, [2.0 ** 40 + i, -3.0 * i, 2.0 ** 39], i % 2) for i in range(40)]
    got = H.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0).collect()
    want = brute(rows, lambda i: i % 10 == 0)
    assert sorted(tuple(r[c] for c in COLUMNS[:4]) for r in got) == [w[:4] for w in want] != []
    assert {r.positive_score for r in got} == {None}  # no long holds them


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0], 0), (10, [0.9, 0.1], 0), (11, [0.9, 0.0], 1), (12, [0.0, 0.0], 1), (100, [-1.0, 0.0], 3)]
    bad = [(1, None, 0), (2, [1.0, 0.0], None), (3, [nan, 1.0], 0), (4, [inf, 0.0], 1), (5, [1.0, None], 1),
           (None, [1.0, 0.0], 1), (6, [1.0], 0), (7, [], 1), (8, [2.0 ** 50, 0.0], 1), (9, None, None)]
    vectors = spark.createDataFrame(good + bad, SCHEMA)
    clash = vectors.withColumns({c: F.lit("x") for c in ("id", "v", "row", "asked", "rank", "score")})
    for frame in (vectors, clash):
        assert mined(frame, F.col("vec_id") % 100 == 0) == brute(good, lambda i: i % 100 == 0) != []
    assert mined(spark.createDataFrame([], SCHEMA), F.lit(True)) == []
    assert mined(vectors, F.lit(None).cast("boolean")) == []
    assert mined(spark.createDataFrame(good[:1], SCHEMA), F.lit(True)) == []


def test_the_bitmap_shrinks_before_the_last_column():
    draw = np.random.default_rng(4)
    weight = 0.6 ** np.arange(32)
    vectors = np.floor(draw.normal(size=(2_000, 32)) * weight * 256)
    block = H.Columns(np.arange(2_000), np.zeros(2_000, np.int64), vectors)
    seen = []

    def keep(low, high):
        seen.append(len(low))
        return high >= np.partition(low, -5)[-5] if len(low) > 5 else np.ones(len(low), bool)

    rows, scores = block.scan(vectors[0], np.arange(2_000), keep)
    exact = block.columns.T @ vectors[0]
    assert set(np.argsort(-exact)[:5]) <= set(rows) and (scores == exact[rows]).all()
    assert seen[0] == 2_000 and seen[1] < 200
