"""Parquet inputs. Column pruning and filter pushdown are left to Catalyst:
callers select what they need and the scan reads only that."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """A parquet table; ``spark.sql.files.maxPartitionBytes`` sets its splits. A
    caller who knows that a small table is one row group (one split, whatever
    that setting) may have its rows dealt to ``partitions`` tasks."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df if partitions is None else df.repartition(partitions)


def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a file stream. A single-file table is named by a
    glob so the file source treats its folder as the stream directory."""
    schema = read_table(spark, sf_dir, name).schema
    path = table_path(sf_dir, name)
    glob = path[:-1] + "[" + path[-1] + "]"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(glob)
