"""Operator 7 against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from reelsync.llm import simhash as S
from reelsync.llm.shared import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, bits=3):
    """code -> smallest code reachable, by comparing all."""
    codes = sorted(set(codes))
    parent = {c: c for c in codes}

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


def signed(code):
    return int(np.array(code, np.uint64).view(np.int64))


def clusters(n, seed, centres=3):
    draw = random.Random(seed)
    base = [draw.getrandbits(64) for _ in range(centres)]
    codes = set()
    while len(codes) < n:
        code = draw.choice(base) if draw.random() < 0.8 else draw.getrandbits(64)
        for _ in range(draw.randint(0, 7)):
            code ^= 1 << draw.randint(0, 63)
        codes.add(code)
    return codes


def same_classes(found, codes):
    want = plain_components(codes)
    classes = {}
    for code in codes:
        classes.setdefault(want[code], set()).add(found[code])
    return all(len(v) == 1 for v in classes.values()) and len({next(iter(v)) for v in classes.values()}) == len(classes)


def test_fingerprints(documents, edge):
    for docs in (documents, edge):
        for r in docs.join(S.fingerprints(docs).dropDuplicates(), "doc_id").collect():
            if r.doc_id not in (1,):
                assert r.fp == signed(plain_fingerprint(r.text))
    assert S.fingerprint(None) == S.fingerprint(" \n") == 0
    for text in ("One", "one TWO", "a b c", "Ünï B c D", "x " * 70_000):
        assert S.fingerprint(text) == plain_fingerprint(text)


def test_gray_ranks_are_in_order(spark):
    codes = [i ^ (i >> 1) for i in range(64)]
    got = spark.createDataFrame([(c,) for c in codes], "fp long").select(S.gray_rank(F.col("fp")).alias("r")).collect()
    assert [r.r for r in got] == list(range(64))


@pytest.mark.parametrize("seed", range(4))
def test_the_index_finds_every_link(seed):
    codes = np.array(sorted(clusters(400, seed), key=lambda c: c), np.uint64)
    draw = random.Random(seed)
    for split in (None, draw.randint(1, 399)):
        forest = S.Forest(len(codes))
        for i, j in S.spanning_links(codes, split, 3):
            forest.link(i, j)
        for i in range(len(codes)):
            for j in range(i + 1, len(codes)):
                near = (int(codes[i]) ^ int(codes[j])).bit_count() <= 3
                if near and (split is None or i < split <= j):
                    assert forest.find(i) == forest.find(j)


def test_hot_places_are_split_without_losing_links(spark):
    codes = list(clusters(1_500, 9, centres=1))
    table = spark.createDataFrame([(i, signed(c)) for i, c in enumerate(codes)], "least long, fp long")
    found = components(S.links(table.select("fp"), place_rows=32), table)
    by = {r.fp: r.component_id for r in found.collect()}
    assert same_classes({c: by[signed(c)] for c in codes}, codes)


def test_blocks_are_cut_once(spark, monkeypatch):
    """Masks and search see the same cuts, although quantiles are estimates."""
    searched = []
    monkeypatch.setattr(S, "_search", lambda places, bits, search=S._search: searched.append(places) or search(places, bits))
    table = spark.createDataFrame([(signed(c),) for c in clusters(200, 3, centres=1)], "fp long")
    S.links(table, place_rows=32)
    assert len(searched) == 2
    for places in searched:
        assert "percentile_approx" not in places._jdf.queryExecution().optimizedPlan().toString()


def test_components_take_the_smallest_id(spark):
    nodes = spark.createDataFrame([(f, 100 - f) for f in range(-5, 40)] + [(99, None)], "fp long, least long")
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 30)] + [(7, 7), (30, 3)], "a long, b long")
    got = {r.fp: r.component_id for r in components(chain, nodes).collect()}
    assert {got[f] for f in range(0, 31)} == {70}
    assert got[-5] == 105 and got[35] == 65 and got[99] is None
    none = components(spark.createDataFrame([], "a long, b long"), nodes)
    assert none.where("fp = 3").first().component_id == 97


def test_near_duplicates(documents, edge, empty):
    for docs in (documents, edge):
        rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
        want = plain_components([fp for _, fp in rows])
        least = {}
        for i, fp in rows:
            if i is not None:
                least[want[fp]] = min(i, least.get(want[fp], i))
        got = sorted(((r.doc_id, r.fp, r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
        assert got == sorted(((i, signed(fp), least.get(want[fp])) for i, fp in rows), key=str)
    assert S.near_duplicates(empty).collect() == []
    clash = edge.withColumns({"fp": F.lit("x"), "component_id": F.lit(0), "least": F.lit(1)})
    assert S.near_duplicates(clash).columns == ["doc_id", "fp", "component_id"]


def test_one_row_of_each_group_stays(spark, edge):
    table = edge.coalesce(1)
    kept = S.keep_one(table).collect()
    groups = plain_components([plain_fingerprint(r.text) for r in edge.collect()])
    assert len(kept) == len(set(groups.values()))
    assert len({groups[plain_fingerprint(r.text)] for r in kept}) == len(kept)
    assert S.keep_one(table).columns == table.columns
    assert next(r for r in kept if plain_fingerprint(r.text) == 0).doc_id == 2


def test_rows_are_numbered_once(spark):
    """Rows that come in another order each time they are computed."""
    def shuffled(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        random.SystemRandom().shuffle(rows)
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    draw = random.Random(5)
    texts = [" ".join(str(draw.getrandbits(32)) for _ in range(30)) for _ in range(40)]
    table = spark.createDataFrame([(i, texts[i % 40]) for i in range(60)], "doc_id long, text string").coalesce(1)
    kept = S.keep_one(table.mapInArrow(shuffled, table.schema)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == list(enumerate(texts))
