"""Operators 1 and 2 against plain versions."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from reelsync.llm import fingerprints as P
from reelsync.llm import mixing as M
from reelsync.llm.shared import following, running


def prints(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r.i: r.fp for r in P.with_fingerprint(frame, "text", "fp").collect()}


def test_order_does_not_matter_and_increments_agree(spark):
    a, b = "First line here.\nSecond one, longer than the first.", "Another. And more\nof it"
    fp = prints(spark, [a + "\n" + b, b + "\n" + a, a, b, a + "\n" + b + "\nx", "", None])
    assert fp[0] == fp[1] != fp[4]
    frame = spark.createDataFrame([(fp[2], fp[3], fp[0])], "a array<long>, b array<long>, both array<long>")
    r = frame.select(P.plus(F.col("a"), F.col("b")).alias("p"), P.minus(F.col("both"), F.col("b")).alias("m")).first()
    assert r.p == fp[0] and r.m == fp[2]
    assert set(fp[5]) == set(fp[6]) == {0} and len(fp[5]) == 1 + P.HASHES * P.LANE_BITS


def test_lanes_against_a_plain_sum(spark):
    text = "One two three. Four five six seven eight nine ten eleven twelve thirteen\n\n fourteen! fifteen"
    pieces = re.findall(P.PIECE, text)
    assert [len(p.split()) for p in pieces] == [3, 8, 2, 1, 1]
    hashes = spark.createDataFrame([(p,) for p in pieces], "p string").select(
        *[F.xxhash64("p", F.lit(k)).alias(f"h{k}") for k in range(P.HASHES)]).collect()
    want = [len(pieces)]
    for k in range(P.HASHES):
        for s in range(P.LANE_BITS):
            want.append(sum((r[f"h{k}"] % (1 << 64)) >> s & P._ONES for r in hashes) & P._ALL)
    assert prints(spark, [text])[0] == want


def plain_edits(rows):
    ids = sorted({r[0] for r in rows}, key=lambda i: (i is not None, i or 0))
    heads = {}
    for i, t in rows:
        heads.setdefault(i, []).append(t or "")
    longest = {i: max(map(len, ts)) // 4 for i, ts in heads.items()}
    out = []
    for i, t in rows:
        t = t or ""
        after = ids[(ids.index(i) + 1) % len(ids)]
        head = min(x[:longest[i]] for x in heads[after])
        q = len(t) // 4
        out.append((i, t, t[:len(t) - q] + head[:q]))
    return sorted(out, key=str)


def test_edits_of_the_next_document(spark, documents, edge, empty):
    for docs in (documents, edge, edge.where("doc_id = 4"), edge.withColumns({"fp": F.lit(1), "head": F.lit("x")})):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = P.edited_fingerprints(docs).select("doc_id", "text", "edited").collect()
        assert sorted([tuple(r) for r in got], key=str) == plain_edits(rows)
    assert P.compared(P.edited_fingerprints(empty)).collect() == []


def test_likeness(spark, documents):
    rows = P.compared(P.edited_fingerprints(documents)).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert sorted(r.near_edited for r in rows)[len(rows) // 2] > 0.6
    assert sorted(r.near_next for r in rows)[len(rows) // 2] < 0.2
    assert all(r.near_edited == 1.0 for r in rows if r.text == r.edited)
    for a in rows:
        assert all(b.fp == a.fp for b in rows if b.text == a.text)


def test_following_and_running(spark):
    ids = [None, *range(0, 200, 3)]
    frame = spark.createDataFrame([(i, (i or 0) * 2) for i in ids], "id long, twice long").repartition(5)
    got = {r.id: (r.next.id, r.next.twice) for r in following(frame, "id", "next", ("twice",)).collect()}
    assert got == {i: (j, (j or 0) * 2) for i, j in zip(ids, [*ids[1:], ids[0]])}
    sums = {r.id: (r.n, r.s) for r in running(frame, ["id"], {"n": F.lit(1), "s": F.col("twice")}).collect()}
    order, total = [*ids[1:], None], 0
    for n, i in enumerate(order):
        assert sums[i] == (n, total)
        total += (i or 0) * 2


def plain_targets(sizes, repeat=3):
    """The rule as stated: share, stop at the limit, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > repeat * sizes[s]}
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = repeat * sizes[s]
            left -= target[s]
        open_ -= over
        if not open_:
            return target


@pytest.mark.parametrize("seed", range(5))
def test_targets(spark, seed):
    draw = random.Random(seed)
    names = draw.sample(["a", "b", "é", "Z", "", "zz", "漢", "😀", "c1", "c2", "c3"], draw.randint(1, 9))
    sizes = {n: draw.choice([0, 1, 5, 100, 10_000, 10 ** 6]) for n in [*names, None]}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.targets(frame).collect()}
    want = plain_targets(sizes)
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix(spark, documents, edge, empty):
    for docs in (documents, edge, edge.withColumns({"size": F.lit("x"), "Copies": F.lit(9), "target": F.lit(1)})):
        rows = M.mix(docs).collect()
        assert len(rows) == docs.count()
        sizes = {}
        for r in rows:
            assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
            sizes[r.source] = sizes.get(r.source, 0) + r.size
        want = plain_targets(sizes)
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
            rate = r.target / r.source_size if r.source_size else 1.0
            drawn = int(hashlib.md5(f"mix:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
            assert r.copies == int(rate) + (drawn < rate - int(rate)) and r.copies <= 3
        out = M.emit(M.mix(docs))
        assert out.count() == sum(r.copies for r in rows)
    assert M.mix(empty).collect() == [] == M.emit(M.mix(empty)).collect()
    assert M.emit(M.mix(documents)).columns == documents.columns


def test_mix_matches_its_sql(spark):
    folder = "/root/testdata/sf0.01/documents.parquet"
    got = M.mix(spark.read.parquet(folder)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")).collect()
    want = duckdb.sql(M.MIX_SQL.replace("FROM documents", f"FROM '{folder}'")).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    taken, target = {}, {}
    for r in got:
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.taken
        target[r.source_size, r.target] = r.target
    assert sum(abs(taken[s] - target[s]) for s in taken) / sum(target.values()) < 0.2
