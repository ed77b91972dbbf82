"""Operator 8: held-out accuracy, the fit, edge rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from reelsync.llm import quality as Q
from reelsync.llm.queries import op8_quality


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    ranking = Q.fit(docs, labels.where(~held))
    rows = Q.score(docs, ranking, drop=("text",)).join(labels.where(held), "doc_id").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    good, bad = s[y == 1], s[y == 0]
    pairs = np.sign(good[:, None] - bad[None, :])
    assert (pairs.mean() + 1) / 2 >= 0.98  # preferred documents rank first
    assert ((s >= 0.5) == (y == 1)).mean() >= 0.95


def test_pairs_order_the_features_that_matter():
    draw = np.random.default_rng(1)
    good, bad = draw.normal(size=(300, 3)), draw.normal(size=(300, 3))
    good[:, 1] += 3
    weights = Q.fit_pairs(good, bad, pairs=5_000)
    assert weights[1] > 5 * abs(weights[0]) and weights[1] > 5 * abs(weights[2])


def test_the_cut_is_the_quantile_of_the_bad_share():
    x = np.arange(100, dtype=float).reshape(-1, 1)
    y = (x[:, 0] >= 20).astype(int)
    scores = Q.Ranking(x, y, 0.2).score(x)
    assert ((scores >= 0.5) == (y == 1)).all()


def test_without_two_classes_every_score_is_even(edge, spark, empty):
    for labels in ([], [(1, 1)], [(1, None), (None, 0), (2, 7)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int")
        scores = {r.score for r in Q.score(edge, Q.fit(edge, frame)).collect()}
        assert scores == {0.5}


def test_edge_rows(edge, empty, spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (6, 0), (7, 1), (99, 1)], "doc_id long, quality int")
    clash = edge.withColumns({"Score": F.lit("x"), "features": F.lit(1)})
    ranking = Q.fit(clash, labels)
    got = Q.score(clash, ranking).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    assert Q.score(empty, ranking).collect() == []
    assert Q.features("") == [0.0] * len(Q.FEATURES) == Q.features(" \n")
    assert all(np.isfinite(Q.features("x" * 3_000_000)))


def test_the_query_equals_a_plain_computation(spark):
    """Folds, labels, fit and scores, row by row without Spark's part."""
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in docs}
    learn = [i for i in sorted(docs) if not held[i] and labels.get(i) in (0, 1)]
    y = np.array([labels[i] for i in learn])
    order = np.lexsort((y, learn))
    x = np.array([Q.features(docs[i]) if docs[i] is not None else Q.features("") for i in learn])
    ranking = Q.Ranking(x[order], y[order], float((y == 0).mean()))
    got = op8_quality(spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        want = float(ranking.score(np.array([Q.features(docs[r.doc_id] or "")]))[0])
        assert r.held_out == held[r.doc_id] and abs(r.score - want) < 1e-9
        assert r.predicted == int(r.score >= 0.5)


def test_an_id_that_holds_a_third_of_all_rows_is_one_row_of_the_sample(spark):
    n = 3_000
    docs = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
                                 F.concat(F.lit("some words of text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    chosen = Q.labelled_sample(labels, "doc_id", "quality", 100)
    assert chosen.count() == chosen.distinct().count() < 400
    whole = Q.fit(docs, labels, per_class=n)
    again = Q.fit(docs.repartition(7), labels.repartition(5), per_class=n)
    assert np.array_equal(whole.weights, again.weights) and whole.cut == again.cut
