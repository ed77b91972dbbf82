"""Structured Streaming: resume from checkpoint, late arrival, fan-out (R-1..R-6)."""

from __future__ import annotations

from reelsync.operators import sinks
from reelsync.operators.changes import films_by_entity
from reelsync.streaming.streams import affected_documents_stream, run_to_end, upsert_stream

from .conftest import film, make_tables, ts

FEED = "id string, modified timestamp_ntz, event_id long, value double"


def feed_stream(spark, folder):
    return spark.readStream.schema(FEED).parquet(folder)


def test_stream_resumes_and_ignores_order(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    late_first = [("a", ts(5), 3, 5.0), ("a", ts(1), 1, 1.0), ("b", ts(2), 2, 2.0),
                  ("a", ts(5), 4, 6.0)]
    spark.createDataFrame(late_first, FEED).repartition(2).write.parquet(src + "/part=1")
    run_to_end(upsert_stream(feed_stream(spark, src), out, ck, ["id"], ["modified", "event_id"]))
    v1 = sinks.current_version(spark, out)
    state = {r["id"]: r["event_id"] for r in sinks.read_current(spark, out).collect()}
    assert state == {"a": 4, "b": 2}
    # restart with nothing new: no batch, no version
    run_to_end(upsert_stream(feed_stream(spark, src), out, ck, ["id"], ["modified", "event_id"]))
    assert sinks.current_version(spark, out) == v1
    # a new file with an older change for "a" and a newer one for "b"
    spark.createDataFrame([("a", ts(0), 9, 0.0), ("b", ts(9), 7, 9.0)], FEED) \
        .write.parquet(src + "/part=2")
    run_to_end(upsert_stream(feed_stream(spark, src), out, ck, ["id"], ["modified", "event_id"]))
    assert sinks.current_version(spark, out) == v1 + 1
    state = {r["id"]: r["event_id"] for r in sinks.read_current(spark, out).collect()}
    assert state == {"a": 4, "b": 7}


def test_affected_stream_equals_batch(spark, tmp_path):
    t = make_tables(spark, films=[film("f1"), film("f2"), film("f3")],
                    persons=[("p1", "Ann", ts(1)), ("p2", "Bob", ts(1))],
                    person_links=[("p1", "f1", "actor"), ("p2", "f2", "actor"),
                                  ("p1", "f3", "writer")])
    src = str(tmp_path / "src")
    changes = spark.createDataFrame([("p1", ts(2), 1, 0.0), ("p1", ts(3), 2, 0.0)], FEED)
    changes.write.parquet(src)
    out = str(tmp_path / "docs")
    run_to_end(affected_documents_stream({"person": feed_stream(spark, src)}, lambda: t, out,
                                         str(tmp_path / "ck")))
    got = sorted(r["id"] for r in sinks.read_current(spark, out).collect())
    want = sorted(r["id"] for r in films_by_entity(t, changes.select("id"), "person").collect())
    assert got == want == ["f1", "f3"]
    doc = {r["id"]: r for r in sinks.read_current(spark, out).collect()}
    assert doc["f3"]["writers_names"] == "Ann"
    assert sinks.current_version(spark, out) == 1


def test_timed_trigger_polls_new_files(spark, tmp_path):
    """R-1: a processing-time trigger picks up files as they arrive."""
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    spark.createDataFrame([("a", ts(1), 1, 1.0)], FEED).write.parquet(src + "/part=1")
    q = upsert_stream(feed_stream(spark, src), out, ck, ["id"], ["modified", "event_id"],
                      trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        spark.createDataFrame([("a", ts(2), 2, 2.0)], FEED).write.parquet(src + "/part=2")
        q.processAllAvailable()
    finally:
        q.stop()
    assert [r["event_id"] for r in sinks.read_current(spark, out).collect()] == [2]


def test_affected_stream_with_several_feeds(spark, tmp_path):
    """R-6 with film and person feeds in one query (one writer)."""
    t = make_tables(spark, films=[film("f1"), film("f2"), film("f3")],
                    persons=[("p1", "Ann", ts(1))],
                    person_links=[("p1", "f1", "actor")])
    films_src, persons_src = str(tmp_path / "films"), str(tmp_path / "persons")
    spark.createDataFrame([("f3", ts(2), 1, 0.0)], FEED).write.parquet(films_src)
    spark.createDataFrame([("p1", ts(2), 2, 0.0), ("nobody", ts(2), 3, 0.0)], FEED) \
        .write.parquet(persons_src)
    out = str(tmp_path / "docs")
    run_to_end(affected_documents_stream(
        {"film_work": feed_stream(spark, films_src), "person": feed_stream(spark, persons_src)},
        lambda: t, out, str(tmp_path / "ck")))
    assert sorted(r["id"] for r in sinks.read_current(spark, out).collect()) == ["f1", "f3"]
