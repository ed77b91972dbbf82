"""Zones, fresh tables in streams, undated rows, bucketed writes, lazy plans."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap
import uuid

import pytest
from pyspark.sql import functions as F

from reelsync.operators import sinks
from reelsync.operators.changes import affected_films, films_by_entity
from reelsync.operators.copy import copy_tables, count_parity, uuid_keys
from reelsync.operators.dedupe import insert_if_absent
from reelsync.operators.documents import build_documents, enrich_fanout
from reelsync.operators.quality import orphan_report, prune_links
from reelsync.operators.sinks import merge_latest
from reelsync.plans import QUERIES
from reelsync.plans.load import SyncPaths, incremental_pass, timed_passes
from reelsync.sources.film import from_catalog, from_parquet
from reelsync.sources.fixtures import film_tables, person_changes
from reelsync.sources.tables import read_table
from reelsync.streaming.streams import affected_documents_stream, run_to_end

from .conftest import SF_SMALL, film, make_tables, ts
from .test_copy_job import sources

ZONE_SCRIPT = """
import datetime as dt, sys, tempfile
from reelsync.operators import changes as C, state as S
from reelsync.session import build_session
from tests.conftest import film, make_tables
spark = build_session("local[2]", conf={"spark.sql.session.timeZone": sys.argv[1], "spark.sql.shuffle.partitions": "2"})
day = lambda h: dt.datetime(2024, 3, 10, h)
ntz = make_tables(spark, films=[film("a", modified=day(6)), film("b", modified=day(2))],
                  persons=[("p", "P", day(7))], genres=[("g", "G", None)])
from pyspark.sql import functions as F
utc = lambda df: df.withColumn("modified", F.expr("timestamp_micros(cast(date_diff(second, timestamp_ntz'1970-01-01', modified) as bigint) * 1000000)"))
for t in (ntz, ntz.replace(film_work=utc(ntz.film_work), person=utc(ntz.person))):
    got = sorted(r["id"] for r in C.changed_since(t.film_work, day(3), day(6)).collect())
    assert got == ["a"], got
    highs = S.as_dict(C.current_highs(t, ["film_work", "person", "genre"]))
    assert highs == {"film_work": day(6), "person": day(7), "genre": None}, highs
print("right")
"""


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_positions_do_not_depend_on_a_zone(session_zone):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(ZONE_SCRIPT), session_zone], cwd=root, text=True,
                         capture_output=True, timeout=300,
                         env={**os.environ, "TZ": "America/New_York", "PYTHONPATH": root})
    assert run.stdout.strip().endswith("right"), run.stderr[-2000:]


def test_a_stream_sees_links_that_were_added_later(spark, tmp_path):
    base = make_tables(spark, films=[film("f1"), film("f2")], persons=[("p1", "Ann", ts(1))],
                       person_links=[("p1", "f1", "actor")])
    root, src, out = (str(tmp_path / n) for n in ("tables", "src", "docs"))
    for name, df in base.as_dict().items():
        df.write.parquet(f"{root}/{name}")
    feed = "id string, modified timestamp_ntz"

    def batch(day):
        spark.createDataFrame([("p1", ts(day))], feed).write.mode("append").parquet(src)
        stream = spark.readStream.schema(feed).parquet(src)
        run_to_end(affected_documents_stream({"person": stream}, lambda: from_parquet(spark, root), out,
                                             str(tmp_path / "ck")))
        return sorted(r["id"] for r in sinks.read_current(spark, out).collect())

    assert batch(2) == ["f1"]
    spark.createDataFrame([("x", "p1", "f2", "writer", None)], base.person_film_work.schema) \
        .write.mode("append").parquet(f"{root}/person_film_work")
    assert batch(3) == ["f1", "f2"]


def test_undated_rows_are_loaded_once(spark, tmp_path):
    t = make_tables(spark, films=[film("f1"), film("f2", modified=ts(1))], persons=[("p1", "Ann", None)],
                    person_links=[("p1", "f1", "actor")], genres=[("g", "G", None)], genre_links=[("g", "f1")])
    paths = SyncPaths(str(tmp_path / "docs"), str(tmp_path / "pos"))
    results = [incremental_pass(t, paths) for _ in range(4)]
    assert [r.version for r in results] == [1, 1, 1, 1]
    assert [r.documents for r in results] == [2, 0, 0, 0]


def test_an_upsert_writes_only_the_touched_buckets(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id string, v int"
    sinks.upsert(spark.createDataFrame([(f"k{i}", 0) for i in range(500)], schema), path, ["id"], buckets=16)
    keys = ["k3", "k77"]
    place = F.pmod(F.xxhash64("id"), F.lit(16)).cast("int")
    touched = {r[0] for r in spark.createDataFrame([(k,) for k in keys], "id string").select(place).collect()}

    def buckets(version):
        return {d for f in os.listdir(f"{path}/data") if f.startswith(f"v={version:08d}-")
                for d in os.listdir(f"{path}/data/{f}") if d.startswith("__")}

    for version in (2, 3, 4):
        sinks.upsert(spark.createDataFrame([(k, version) for k in keys], schema), path, ["id"], share=0)
        assert buckets(version) == {f"__bucket={b}" for b in touched}
        rows = {r["id"]: r["v"] for r in sinks.read_current(spark, path).collect()}
        assert len(rows) == 500 and {k for k, v in rows.items() if v == version} == set(keys)
    # files that none of the last two versions uses are gone, the others stay
    assert buckets(2) == set()
    assert buckets(1) == {f"__bucket={b}" for b in range(16)} - {f"__bucket={b}" for b in touched}


def test_a_second_writer_is_noticed_and_destroys_nothing(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "id string, v int"
    sinks.upsert(spark.createDataFrame([("a", 1), ("b", 1)], schema), path, ["id"])
    write, raced = sinks._write, []

    def slow_write(rows, *args):
        if not raced:  # another writer commits version 2 between this one's read of the log and its commit
            raced.append(1)
            assert sinks.upsert(spark.createDataFrame([("a", 2), ("c", 2)], schema), path, ["id"]) == 2
        return write(rows, *args)

    monkeypatch.setattr(sinks, "_write", slow_write)
    with pytest.raises(sinks.ConcurrentWrite):
        sinks.upsert(spark.createDataFrame([("a", 9), ("b", 9)], schema), path, ["id"])
    assert sinks.current_version(spark, path) == 2
    assert sorted(map(tuple, sinks.read_current(spark, path).collect())) == [("a", 2), ("b", 1), ("c", 2)]
    assert sinks.vacuum(spark, path) == []  # the loser removed what it wrote
    assert sinks.upsert(spark.createDataFrame([("a", 9), ("b", 9)], schema), path, ["id"]) == 3  # and may try again
    assert sorted(map(tuple, sinks.read_current(spark, path).collect())) == [("a", 9), ("b", 9), ("c", 2)]


def jobs_started(spark, define):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "plans being defined")
    try:
        frame = define()
        return frame, len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_defining_a_plan_starts_no_job(spark):
    tables = film_tables(spark, SF_SMALL)
    lines = read_table(spark, SF_SMALL, "lineitem")
    feed = person_changes(spark, SF_SMALL)
    changed = {e: tables.as_dict()[e].select("id") for e in ("film_work", "person", "genre")}
    key = [["l_orderkey", "l_linenumber"]]
    for define in (lambda: build_documents(tables), lambda: enrich_fanout(tables),
                   lambda: affected_films(tables, changed), lambda: enrich_fanout(tables, affected_films(tables, changed)),
                   lambda: build_documents(tables, limit=5), lambda: films_by_entity(tables, changed["genre"], "genre"),
                   lambda: count_parity(tables.as_dict(), tables.as_dict()), lambda: orphan_report(tables.as_dict()),
                   lambda: prune_links(tables.as_dict()), lambda: insert_if_absent(lines, lines.limit(9), key),
                   lambda: merge_latest(feed, feed, ["id"], ["modified", "event_id"])):
        frame, jobs = jobs_started(spark, define)
        assert jobs == 0 and frame is not None


def test_one_scan_of_each_table(spark, tmp_path):
    root = str(tmp_path / "tables")
    t = make_tables(spark, films=[film("f1")], persons=[("p", "P", None)], person_links=[("p", "f1", "actor")],
                    genres=[("g", "G", None)], genre_links=[("g", "f1")])
    for name, df in t.as_dict().items():
        df.write.parquet(f"{root}/{name}")
    opened, jobs = jobs_started(spark, lambda: enrich_fanout(from_parquet(spark, root)))
    del jobs
    plan = opened._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 5
    plan = QUERIES["insert_if_absent"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2  # the rows, and the target's keys


def test_copy_drops_orphans_before_keep_first_and_refuses_null_keys(spark, tmp_path):
    links = [("l1", "p1", "gone", "actor", None), ("l1", "p1", "f1", "actor", None)]
    report = {r["table_name"]: r["target_rows"]
              for r in copy_tables(sources(spark, links), str(tmp_path / "a"), on_orphans="drop").collect()}
    assert report["person_film_work"] == 1
    for bad in ([(None, "p1", "f1", "actor", None)], [("l1", "p1", "f1", "x" * 251, None)]):
        with pytest.raises(Exception, match="is NULL|is longer than 250"):
            copy_tables(sources(spark, bad), str(tmp_path / f"b{len(str(bad))}"))
    assert copy_tables(sources(spark, []), str(tmp_path / "a")).where("not match").count() == 1


def test_uuid_keys(spark):
    good = "0A1B2C3D-0000-4000-8000-00000000000F"
    frame = spark.createDataFrame([(good, None, good, "actor", None)], "id string, person_id string, "
                                  "film_work_id string, role string, created timestamp")
    assert uuid_keys(frame, "person_film_work").first()["id"] == good.lower()
    with pytest.raises(Exception, match="no uuid"):
        uuid_keys(frame.withColumn("id", F.lit("7")), "person_film_work").collect()


def test_sources_and_the_timed_command(spark, tmp_path, capsys):
    import json

    from reelsync.__main__ import main
    t = make_tables(spark, films=[film("f1", modified=ts(1))], persons=[("p", "P", ts(1))],
                    person_links=[("p", "f1", "actor")], genres=[("g", "G", ts(1))], genre_links=[("g", "f1")])
    root, out = str(tmp_path / "tables"), str(tmp_path / "out")
    for name, df in t.as_dict().items():
        df.write.parquet(f"{root}/{name}")
        df.write.mode("overwrite").saveAsTable(f"kept_{name}")
    assert build_documents(from_catalog(spark, "kept_")).collect() == build_documents(t).collect()
    assert main(["stream", "--parquet", root, "--root", out, "--master", "local[*]", "--passes", "2"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [(x["pass_id"], x["version"], x["documents"]) for x in lines] == [(1, 1, 1), (2, 1, 0)]
    with pytest.raises(Exception, match="no uuid"):  # text ids are held to be uuids
        main(["copy", "--parquet", root, "--root", f"{out}/strict", "--master", "local[*]"])
    assert main(["copy", "--parquet", root, "--root", out, "--master", "local[*]", "--any-keys"]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert len(rows) == 5 and all(r["match"] for r in rows)
    ran = []
    timed_passes(spark, lambda: from_parquet(spark, root), SyncPaths(f"{out}/documents", f"{out}/positions"),
                 every="100 milliseconds", passes=1, on_pass=ran.append)
    assert len(ran) == 1
