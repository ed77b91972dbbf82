"""Repeats across micro-batches (R-4) and counts of micro-batches (A-9)."""

from __future__ import annotations

from reelsync.operators import sinks
from reelsync.streaming.batch_counts import BatchCounts
from reelsync.streaming.streams import affected_documents_stream, run_to_end, upsert_stream

from .conftest import film, make_tables, ts

FEED = "id string, modified timestamp_ntz"


def test_a_change_repeated_in_a_later_batch_rebuilds_nothing(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    base = make_tables(spark, films=[film("f1"), film("f2")], persons=[("p1", "Ann", ts(1)), ("p2", "Bob", ts(1))],
                       person_links=[("p1", "f1", "actor"), ("p2", "f2", "actor")])
    src, out, rebuilt = str(tmp_path / "src"), str(tmp_path / "docs"), []

    def batch(*changes):
        spark.createDataFrame(list(changes), FEED).coalesce(1).write.mode("append").parquet(src)
        before = len(rebuilt)
        run_to_end(affected_documents_stream(
            {"person": spark.readStream.schema(FEED).parquet(src)}, lambda: base, out, str(tmp_path / "ck"),
            on_batch=lambda _, films: rebuilt.append(sorted(r["id"] for r in films.collect())), repeats_within="1 hour"))
        return [f for f in rebuilt[before:] if f]

    try:
        assert batch(("p1", ts(2)), ("p1", ts(2))) == [["f1"]]
        assert batch(("p1", ts(2)), ("p2", ts(2))) == [["f2"]]  # the first one is a repeat
        assert batch(("p1", ts(2, 1))) == [["f1"]]              # a later change of the same person
        # the watermark has moved on: what it passed is out of the state, and late
        assert batch(("p2", ts(9))) == [["f2"]]
        assert batch(("p1", ts(9)), ("p2", ts(9))) == [["f1"]]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(r["id"] for r in sinks.read_current(spark, out).collect()) == ["f1", "f2"]


def test_a_row_per_micro_batch_also_after_a_restart(spark, tmp_path):
    src, out, ck, path = (str(tmp_path / n) for n in ("src", "out", "ck", "counts"))

    def run():
        counts = BatchCounts(spark, path)
        stream = spark.readStream.schema(FEED).option("maxFilesPerTrigger", "1").parquet(src)
        run_to_end(upsert_stream(stream, out, ck, ["id"], ["modified"], counts=counts))
        counts.close()
        return sorted(map(tuple, counts.read().collect()))

    for day in (1, 2):
        spark.createDataFrame([(f"p{i}", ts(day)) for i in range(day)], FEED).coalesce(1).write.mode("append").parquet(src)
    first = run()
    assert [b for b, _ in first] == [0, 1] and sorted(n for _, n in first) == [1, 2]
    assert run() == first  # nothing new
    spark.createDataFrame([(f"q{i}", ts(3)) for i in range(5)], FEED).coalesce(1).write.mode("append").parquet(src)
    assert run() == [*first, (2, 5)]


def test_no_batch_no_count(spark, tmp_path):
    counts = BatchCounts(spark, str(tmp_path / "counts"))
    assert counts.read().collect() == []
    counts.close()
