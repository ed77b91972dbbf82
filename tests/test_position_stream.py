"""A change table as a stream by position: restarts, ties, rewritten files."""

from __future__ import annotations

import random

from pyspark.sql.types import StructType

from reelsync.operators import changes as C
from reelsync.sources.position_stream import PositionReader, position_stream
from reelsync.streaming.streams import run_to_end

from .conftest import film, make_tables, ts

FEED = "id string, modified timestamp_ntz, note string"


def reader(path, **options):
    return PositionReader(StructType.fromDDL(FEED), {"path": path, **{k: str(v) for k, v in options.items()}})


def runner(spark, tmp_path, name="ck"):
    """Runs the stream over ``src`` to its end; returns the ids of that run."""
    src, seen = str(tmp_path / "src"), []

    def run(**options):
        seen.clear()

        def keep(batch, _):
            seen.extend(r["id"] for r in batch.collect())

        stream = position_stream(spark, src, FEED, **options)
        run_to_end(stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / name))
                   .trigger(availableNow=True).start())
        return sorted(seen, key=str)

    def write(*rows, mode="append"):
        spark.createDataFrame([(i, m, None) for i, m in rows], FEED).coalesce(1).write.mode(mode).parquet(src)

    return run, write


def test_a_restart_reads_nothing_twice_and_ties_are_not_lost(spark, tmp_path):
    run, write = runner(spark, tmp_path)
    write(("a", ts(1)), ("b", ts(2)), ("c", ts(2)), ("n", None))
    assert run() == ["a", "b", "c", "n"]      # the first one has the undated row
    assert run() == []
    write(("d", ts(2)), ("e", ts(3)), ("m", None))
    assert run() == ["d", "e"]                # a later id joins the newest tie; undated ones are no changes
    assert run() == []
    # every file is rewritten, one row has changed: it alone is read
    write(("a", ts(4)), ("b", ts(2)), ("c", ts(2)), ("d", ts(2)), ("e", ts(3)), mode="overwrite")
    assert run() == ["a"]


def test_bounds(spark, tmp_path):
    run, write = runner(spark, tmp_path)
    write(*((f"r{d}", ts(d)) for d in range(1, 7)), ("n", None), ("x", ts(4)))
    assert run(after=ts(2).isoformat(), until=ts(4).isoformat()) == ["r3", "r4", "x"]
    assert run(after=ts(2).isoformat()) == ["r5", "r6"]  # from the checkpoint on


def test_empty_tables(spark, tmp_path):
    run, write = runner(spark, tmp_path)
    assert run() == []  # no folder yet
    spark.createDataFrame([], FEED).coalesce(1).write.parquet(str(tmp_path / "src"))
    assert run() == []
    write(("n", None))
    write((None, ts(1)))
    assert set(run()) == {None, "n"}
    assert run() == []


def test_only_row_groups_of_the_slice_are_read(spark, tmp_path):
    src = str(tmp_path / "src")
    for day in range(10):
        spark.createDataFrame([(f"{day}-{i}", ts(day, i), None) for i in range(20)], FEED).coalesce(1).write.mode(
            "append").parquet(src)
    r = reader(src)
    low, high = {"modified": r.latestOffset()["modified"] - 86_400_000_000, "id": "8-19"}, r.latestOffset()
    assert high["id"] == "9-19"
    assert len(r.partitions(low, high)) == 2 and len(r.partitions(r.initialOffset(), high)) == 10
    assert sum(b.num_rows for p in r.partitions(low, high) for b in r.read(p)) == 20
    assert sum(len(p.groups) for p in reader(src, rows_per_task=1).partitions(low, high)) == 2


def test_random_slices_cover_every_row_once(spark, tmp_path):
    rng, src = random.Random(5), str(tmp_path / "src")
    rows = [(f"i{k}", ts(rng.randrange(6)) if rng.random() < 0.9 else None, "x") for k in range(300)]
    spark.createDataFrame(rows, FEED).repartition(3).write.parquet(src)
    r = reader(src)
    first, last = r.initialOffset(), r.latestOffset()
    day = r.latestOffset()["modified"] - 86_400_000_000
    cuts = [first, *({"modified": day - d * 86_400_000_000, "id": rng.choice(rows)[0]} for d in (3, 1, 0)), last]
    got = [i for a, b in zip(cuts, cuts[1:]) for p in r.partitions(a, b) for t in r.read(p) for i in t.column("id").to_pylist()]
    assert sorted(got) == sorted(i for i, _, _ in rows)


def test_equals_the_films_of_the_changes(spark, tmp_path):
    run, write = runner(spark, tmp_path)
    people = [(f"p{i}", f"name {i}", ts(i)) for i in range(6)]
    tables = make_tables(spark, films=[film(f"f{i}") for i in range(6)], persons=people,
                         person_links=[(f"p{i}", f"f{(i + k) % 6}", "actor") for i in range(6) for k in range(2)])
    write(*((i, m) for i, _, m in people))
    ids = spark.createDataFrame([(i,) for i in run(after=ts(3).isoformat())], "id string")
    changed = C.changed_since(tables.person, ts(3))
    assert (sorted(map(tuple, C.films_by_entity(tables, ids, "person").collect()))
            == sorted(map(tuple, C.films_by_entity(tables, changed, "person").collect())))
