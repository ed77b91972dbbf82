"""The JDBC option builder (the reader itself needs a driver jar)."""

from __future__ import annotations

import pytest

from reelsync.sources.jdbc import jdbc_options


def test_partitioned_read_options():
    opts = jdbc_options("jdbc:postgresql://db/movies", "content.film_work",
                        partition_column="rank", lower_bound=0, upper_bound=1000,
                        num_partitions=16, fetchsize=500, user="app")
    assert opts == {"url": "jdbc:postgresql://db/movies", "dbtable": "content.film_work",
                    "partitionColumn": "rank", "lowerBound": "0", "upperBound": "1000",
                    "numPartitions": "16", "fetchsize": "500", "user": "app"}


def test_partition_column_needs_bounds():
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")
