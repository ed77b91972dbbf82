"""The layered upsert table: bytes written, reads, merging, growth, crashes."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from reelsync.operators import sinks
from reelsync.operators import versions as V
from reelsync.session import publish_text, read_text

SCHEMA = "id long, v int, payload string"


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def rows(spark, path, **kw):
    return sorted(map(tuple, sinks.read_current(spark, path, **kw).collect()))


def batch(spark, changes):
    return spark.createDataFrame(changes, SCHEMA)


def test_bytes_follow_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(1_000_000).select("id", F.lit(0).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    sinks.upsert(table, path, ["id"], assume_unique=True)
    whole = size(f"{path}/data")
    assert whole > 40_000_000
    sinks.upsert(table.where("id % 10000 = 7").withColumn("v", F.lit(1)), path, ["id"])
    assert size(f"{path}/data") - whole < 200_000  # 100 rows, a small file in each of 32 buckets
    assert sinks.read_current(spark, path).agg(F.count("*"), F.sum("v")).first() == (1_000_000, 100)


@pytest.mark.parametrize("order", [None, ["v"]])
def test_any_sequence_of_batches_equals_a_plain_replay(spark, tmp_path, order):
    draw, path, want = random.Random(7), str(tmp_path / "t"), {}
    for step in range(9):
        changes = {draw.randrange(60): draw.randrange(9) for _ in range(draw.choice([3, 12, 40]))}
        for key, v in changes.items():
            if order is None or key not in want or v >= want[key][0]:
                want[key] = (v, f"s{step}")
        sinks.upsert(batch(spark, [(k, v, f"s{step}") for k, v in changes.items()]), path, ["id"], order,
                     buckets=4, share=0.5, layers=2)
        assert rows(spark, path) == sorted((k, *v) for k, v in want.items())
    before = rows(spark, path)
    assert sinks.rebucket(spark, path, 7) == 10
    assert rows(spark, path) == rows(spark, path, version=9) == before
    sinks.upsert(batch(spark, [(3, 99, "last")]), path, ["id"], order)
    assert (3, 99, "last") in rows(spark, path) and len(V.load(spark, path).layers) == 7


def test_small_layers_are_merged_without_the_base(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(batch(spark, [(i, 0, "base") for i in range(200)]), path, ["id"], buckets=1)
    base = V.load(spark, path).layers[0][0]
    for step in range(1, 8):
        sinks.upsert(batch(spark, [(step % 3, step, "new")]), path, ["id"], layers=2)
        state = V.load(spark, path)
        assert state.layers[0][0] == base and len(state.layers[0]) <= 3
    assert rows(spark, path)[:4] == [(0, 6, "new"), (1, 7, "new"), (2, 5, "new"), (3, 0, "base")]
    sinks.upsert(batch(spark, [(i, 9, "many") for i in range(60)]), path, ["id"])
    assert len(V.load(spark, path).layers[0]) == 1  # past the share: a new base
    assert len(rows(spark, path)) == 200


def test_a_crash_leaves_the_table_and_vacuum_cleans_up(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(batch(spark, [(1, 1, "a")]), path, ["id"])
    os.makedirs(f"{path}/data/v=00000002-dead/__bucket=0")  # as a killed driver leaves it
    assert rows(spark, path) == [(1, 1, "a")]
    assert sinks.upsert(batch(spark, [(1, 2, "b")]), path, ["id"]) == 2
    assert sinks.vacuum(spark, path) == ["v=00000002-dead"]
    with pytest.raises(Exception, match="broken"):
        sinks.upsert(batch(spark, [(1, 3, "c")]).withColumn("payload", F.raise_error(F.lit("broken"))), path, ["id"])
    assert rows(spark, path) == [(1, 2, "b")] and sinks.vacuum(spark, path) == []


def test_the_log_takes_a_number_once(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    assert publish_text(spark, path, "first é") and not publish_text(spark, path, "second")
    assert read_text(spark, path) == "first é"
    assert [f for f in os.listdir(tmp_path / "log") if not f.endswith(".crc")] == ["1.json"]


def test_key_and_version_columns_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(batch(spark, [(1, 1, "a")]), path, ["id"], ["v"])
    with pytest.raises(ValueError, match="version columns"):
        sinks.upsert(batch(spark, [(1, 1, "a")]), path, ["id"])


def test_an_empty_batch_creates_nothing_through_the_sink(spark, tmp_path):
    sink = sinks.parquet_upsert_sink(str(tmp_path / "t"))
    assert sinks.write_documents(batch(spark, []), sink) is None
    assert sinks.read_current(spark, str(tmp_path / "t")) is None
    assert sinks.write_documents(batch(spark, [(1, 1, "a")]), sink) == 1
    assert sinks.write_documents(batch(spark, []), sink) is None
