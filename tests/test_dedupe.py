"""Keep-first de-duplication (A-8, D-17) against a brute-force greedy loop."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelsync.operators.copy import copy_table
from reelsync.operators.dedupe import insert_if_absent, keep_first

SCHEMA = "seq int, k string, n string"


def greedy(rows, keys, taken=()):
    """Rows in sequence order; accept unless a non-NULL key is taken."""
    used = [set() for _ in keys]
    for t in taken:
        for i, key in enumerate(keys):
            v = tuple(t[c] for c in key)
            if None not in v:
                used[i].add(v)
    out = []
    for r in sorted(rows, key=lambda r: r["seq"]):
        vals = [tuple(r[c] for c in key) for key in keys]
        if any(None not in v and v in used[i] for i, v in enumerate(vals)):
            continue
        for i, v in enumerate(vals):
            if None not in v:
                used[i].add(v)
        out.append(r)
    return sorted(r["seq"] for r in out)


def run(spark, rows, keys, target=None):
    df = spark.createDataFrame(rows, SCHEMA)
    tgt = spark.createDataFrame(target, SCHEMA) if target is not None else None
    return sorted(r["seq"] for r in insert_if_absent(df, tgt, keys, ["seq"]).collect())


def test_chained_conflict(spark):
    rows = [(1, "1", "a"), (2, "2", "a"), (3, "2", "b")]
    assert run(spark, rows, [["k"], ["n"]]) == [1, 3]


def test_null_key_part_never_conflicts(spark):
    rows = [(1, "x", None), (2, "y", None), (3, None, None), (4, None, None)]
    assert run(spark, rows, [["k"], ["n"]]) == [1, 2, 3, 4]
    assert run(spark, rows, [["k"]]) == [1, 2, 3, 4]


def test_exact_duplicates_keep_one(spark):
    rows = [(1, "a", "x"), (1, "a", "x")]
    assert len(run(spark, rows, [["k"], ["n"]])) == 1


def test_target_rows_win(spark):
    rows = [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]
    assert run(spark, rows, [["k"], ["n"]], target=[(0, "a", "q"), (0, "q", "z")]) == [2]


def test_one_key_first_row(spark):
    df = spark.createDataFrame([(3, "a", "z"), (1, "a", "y"), (2, "b", "x")], SCHEMA)
    got = sorted((r["seq"], r["n"]) for r in keep_first(df, ["k"], ["seq"]).collect())
    assert got == [(1, "y"), (2, "x")]


keys_st = st.sampled_from(["a", "b", "c", "d", None])
rows_st = st.lists(st.tuples(keys_st, keys_st), min_size=0, max_size=14)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_matches_greedy(spark, rows):
    data = [(i, k, n) for i, (k, n) in enumerate(rows)]
    expected = greedy([{"seq": s, "k": k, "n": n} for s, k, n in data], [["k"], ["n"]])
    assert run(spark, data, [["k"], ["n"]]) == expected


def test_copy_twice_is_copy_once(spark):
    src = spark.createDataFrame(
        [("g1", "f1", "l1"), ("g1", "f1", "l2"), ("g2", "f1", "l3")],
        "genre_id string, film_work_id string, id string")
    src = src.selectExpr("id", "genre_id", "film_work_id", "CAST(NULL AS timestamp) AS created_at")
    first = copy_table("genre_film_work", src)
    assert sorted(r["id"] for r in first.collect()) == ["l1", "l3"]
    second = copy_table("genre_film_work", src, target=first)
    assert second.count() == 0


def test_many_exact_copies_keep_one(spark):
    rows = [(1, "a", "x")] * 200 + [(2, "a", "y"), (3, "b", "x"), (4, "b", "z")]
    assert run(spark, rows, [["k"], ["n"]]) == [1, 4]
