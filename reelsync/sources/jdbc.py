"""S-1 / S-2: relational sources through Spark's JDBC reader.

A thin set of options, not a connector: Spark plans the read. A numeric or
date ``partition_column`` with bounds splits the scan into ``num_partitions``
parallel range queries; ``fetchsize`` is the driver's batch size (the
reference's ``BATCH_SIZE``). No JDBC driver for PostgreSQL or SQLite ships
with this build, so these functions are untested here; tests read parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, *, partition_column: str | None = None,
                 lower_bound: int | str | None = None, upper_bound: int | str | None = None,
                 num_partitions: int | None = None, fetchsize: int | None = None,
                 user: str | None = None, password: str | None = None,
                 driver: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    for key, value in (("fetchsize", fetchsize), ("user", user), ("password", password),
                       ("driver", driver)):
        if value is not None:
            opts[key] = str(value)
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A table (or a parenthesised query aliased as a table) read over JDBC."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def write_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Append rows, e.g. the accepted rows of ``copy_table``, to a table."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("append").save()
