"""F-5 / F-6 / F-7 / A-9: position state as JSON, merging, observed counts."""

from __future__ import annotations

import json

from reelsync.operators import state as S
from reelsync.operators.counts import counted, rows_of
from reelsync.schemas import HIGH_WATER

from .conftest import ts


def test_state_round_trip_and_merge(spark):
    old = spark.createDataFrame([("genre", ts(1), 1), ("person", None, 1)], HIGH_WATER)
    new = spark.createDataFrame([("person", ts(3), 2)], HIGH_WATER)
    current = S.merge_positions(old, new)
    assert S.as_dict(current) == {"genre": ts(1), "person": ts(3)}
    text = S.state_json(current).collect()[0]["state"]
    assert json.loads(text) == {"genre": "2024-01-02T00:00:00.000000",
                                "person": "2024-01-04T00:00:00.000000"}
    back = S.positions_from_json(S.state_json(current))
    assert S.as_dict(back) == S.as_dict(current)


def test_observed_counts(spark):
    df, obs = counted(spark.range(10).where("id % 2 = 0"), "evens")
    df.write.format("noop").mode("overwrite").save()
    assert rows_of(obs) == 5
