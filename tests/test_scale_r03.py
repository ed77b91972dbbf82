"""Jobs that read costly sources several times, and new bases of stored tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from reelsync.operators import sinks
from reelsync.operators import versions as V
from reelsync.operators.dedupe import keep_first_keys
from reelsync.operators.documents import build_documents, person_branch
from reelsync.plans.stream_queries import backlog_documents
from reelsync.sources.fixtures import DEALT, film_tables
from reelsync.sources.layout import bucketed

from .conftest import SF_SMALL

SCHEMA = "id long, v int"


def files(df):
    return len(df.inputFiles())


def test_a_job_reads_its_sources_once(spark):
    t = film_tables(spark, SF_SMALL)
    before = {r.tableName for r in spark.sql("SHOW TABLES").collect()}
    with bucketed(t, DEALT) as b:
        docs = build_documents(b)
        assert "Exchange hashpartitioning" not in docs._jdf.queryExecution().executedPlan().toString()
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert all(0 < files(df) <= buckets for df in (b.film_work, b.person_film_work, b.genre_film_work))
        want = build_documents(t)
        assert docs.exceptAll(want).count() == 0 and want.exceptAll(docs).count() == 0
    assert {r.tableName for r in spark.sql("SHOW TABLES").collect()} == before


def test_link_views_come_by_film(spark):
    t = film_tables(spark, SF_SMALL)
    plan = person_branch(t.person_film_work, t.person)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(film_work_id") == 1  # the links once, not their lists again


def recorded(monkeypatch):
    sizes, write = [], sinks._write
    monkeypatch.setattr(sinks, "_write", lambda rows, *a: (sizes.append(rows.count()), write(rows, *a))[1])
    return sizes


def test_a_new_base_writes_only_the_rows_that_stay(spark, tmp_path, monkeypatch):
    path, sizes = str(tmp_path / "t"), recorded(monkeypatch)
    row = lambda i, v: (i, v)
    sinks.upsert(spark.createDataFrame([row(i, 0) for i in range(200)] + [(None, 0)], SCHEMA), path, ["id"], buckets=1, assume_unique=True)
    want = {i: 0 for i in range(200)}
    for step, changed in enumerate((range(60), range(10, 200), range(0, 220, 2)), 1):  # a third, nearly all, half and new ones
        sinks.upsert(spark.createDataFrame([row(i, step) for i in changed], SCHEMA), path, ["id"])
        want.update(dict.fromkeys(changed, step))
        got = sinks.read_current(spark, path).collect()
        assert sorted(map(tuple, got), key=str) == sorted([*want.items(), (None, 0)], key=str)
        state = V.load(spark, path)
        assert [layer[1:] for layer in state.layers[0]] == [[len(want) + 1, step + 1]]
        assert os.listdir(f"{path}/data/{state.layers[0][0][0]}") and sinks.vacuum(spark, path) == []
    assert sizes == [201, 60, 141, 190, 11, 110, 101]


def test_a_backlog_leaves_no_tables(spark):
    before = {r.tableName for r in spark.sql("SHOW TABLES").collect()}
    want = {r["id"] for r in film_tables(spark, SF_SMALL).film_work.select("id").collect()}
    assert {int(r["id"]) for r in backlog_documents(spark, SF_SMALL).collect()} == want
    assert {r.tableName for r in spark.sql("SHOW TABLES").collect()} == before


def test_rows_without_rivals_are_not_written_down(spark, monkeypatch):
    written, checkpoint = [], type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda df, *a: (written.append(df.count()), checkpoint(df, *a))[1])
    df = spark.range(500).select("id", F.concat(F.lit("n"), "id").alias("name"))
    assert keep_first_keys(df, [["id"], ["name"]]).count() == 500
    assert written == [0, 0]  # the keys that repeat
    more = df.unionByName(spark.createDataFrame([(7, "x600"), (600, "n8"), (None, "n9")], "id long, name string"))
    got = keep_first_keys(more, [["id"], ["name"]])  # 7 and n8 are taken, n9 goes to the row that comes first
    assert got.count() == 500 and got.where("id = 600 or name = 'x600'").count() == 0
    assert got.where("name = 'n9'").first()["id"] is None
