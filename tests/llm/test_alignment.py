"""Operator 13: against plain alignments of the libraries' whole-text tokens."""

import hashlib
import random
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

from reelsync.llm import alignment as A
from reelsync.llm.queries import QUERIES
from reelsync.llm.shared import stored

PATHS = [str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def plain(aligner, text):
    """Token counts, groups, links of the whole text, every pair compared."""
    if not text:
        return 0, 0, "", []
    a = aligner.a.encode(" " + text, add_special_tokens=False)
    b = aligner.b.encode(text)
    sides = [[bytes(aligner.bytes_a[c] for c in t) for t in a.tokens], [aligner.bytes_b[i] for i in b]]
    if any(b"".join(s) != b" " + text.encode() for s in sides):
        return 0, 0, "", []
    spans = []
    for side in sides:
        at = [0]
        for token in side:
            at.append(at[-1] + len(token))
        spans.append(list(zip(at, at[1:])))
    links = [(a.ids[i], b[j]) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
    groups, low = [], 0
    for high in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
        inside = lambda side, ids: ",".join(str(i) for i, (s, _) in zip(ids, side) if low <= s < high)
        groups.append(inside(spans[0], a.ids) + "|" + inside(spans[1], b))
        low = high
    return len(a.ids), len(b), ";".join(groups), links


def same(aligner, *rows):
    for text, got in zip(rows, aligner.align(list(rows)), strict=True):
        agree(aligner, text, got)


def agree(aligner, text, got):
    n_a, n_b, groups, links = plain(aligner, text)
    assert got[:2] == (n_a, n_b) and got[4] == groups, repr(text)
    assert got[2] == (groups.count(";") + 1 if groups else 0) and got[3] == len(links)
    assert got[5].tolist() == [i * aligner.size_b + j for i, j in links]


def test_random_texts():
    draw, aligner = random.Random(13), A.Aligner(*PATHS)
    assert not aligner.whole
    parts = ["<|endoftext|>", "<s>", "<0x41>", " ", " ", "  ", "\n", " \n", "\t", "'s", "the", "Zürich", "ſ", "Σ", "İ", "é",
             "漢字", "½", "1", "!?", "\x1c", "\x85", " ", "😀", "͸", "\U0001e6c0", "a", "\x00", "​", "　",
             "👨‍👩‍👧", "ﬁ", "é", "한국어", "नमस्ते", "▁"]
    for _ in range(500):
        same(aligner, *["".join(draw.choice(parts[:-1] if k % 9 else parts) for _ in range(draw.randint(0, 14))) for k in range(9)])


def test_long_and_plain_texts(documents):
    aligner = A.Aligner(*PATHS)
    for r in documents.orderBy("doc_id").limit(40).collect():
        if len(r.text) < 4_000:
            same(aligner, r.text)
    for text in ("a" * 3_000, "漢" * 500, " " * 700, "x \n" * 300):
        same(aligner, text)


def wanted(rows):
    """The query's rows by brute force."""
    aligner = A.Aligner(*PATHS)
    found = [(r.doc_id, *plain(aligner, r.text)) for r in rows]
    held = Counter(p for f in found for p in set(f[4]))
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(repr((i, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links),
                        sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                        hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
                  for i, n_a, n_b, groups, links in found)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def test_counts_over_all_documents(spark, documents, edge):
    extra = spark.createDataFrame([(-1, "the▁end"), (-2, "the end"), (-2, "the end"), (-3, "漢字 the <s>")], "doc_id long, text string")
    short = documents.select("doc_id", "text").where("length(text) < 1500").unionByName(extra).unionByName(
        edge.select("doc_id", "text").where("text is null or length(text) < 1500"))
    want = wanted(short.collect())
    for frequent in (A.FREQUENT, 300, 0):  # all pairs broadcast, some, none
        written = stored(A.align(short, *PATHS))
        got = A.scored(written, frequent=frequent)
        digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
        assert sorted(repr(tuple(r)) for r in got.select(*NAMES, digest).collect()) == want


def test_the_query_and_edge_rows(spark, empty, edge):
    assert A.scored(stored(A.align(empty, *PATHS))).collect() == []
    clash = edge.withColumns({c: F.lit("x") for c in ("n_a", "groups", "pair_a", "times", "_row", "a", "n", "best")})
    out = A.scored(stored(A.align(clash, *PATHS)))
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert out.count() == edge.count()
    got = QUERIES["op13_alignment"](spark, "/root/testdata/sf0.001")
    assert got.columns == [*NAMES, "groups_sha256"]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
