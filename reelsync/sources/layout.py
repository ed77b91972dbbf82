"""A co-located storage layout for the five tables.

Documents are built by film id: the link tables are aggregated by
``film_work_id`` and joined to ``film_work`` by ``id``. Written as catalog
tables bucketed on those columns with one bucket count, the branch
aggregates and both joins read co-partitioned data and need no shuffle at
all; the small dimensions (person, genre) are plain tables. This is the
layout to keep the copy targets in at scale (``spark.sql.warehouse.dir`` on
shared storage).
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .film import FilmTables

# Table -> its film-id column (the bucket key); dimensions are not bucketed.
BUCKET_KEYS = {"film_work": "id", "person_film_work": "film_work_id",
               "genre_film_work": "film_work_id"}


# What loads read of link rows; the layout of one job keeps nothing else of them.
LINK_COLUMNS = {"person_film_work": ["person_id", "film_work_id", "role"],
                "genre_film_work": ["genre_id", "film_work_id"]}


def table_name(prefix: str, table: str) -> str:
    return f"{prefix}_{table}"


def save_bucketed(tables: FilmTables, prefix: str, buckets: int, dealt: Collection[str] = ()) -> None:
    """Write the five tables as catalog tables, film-keyed ones bucketed and
    sorted by film id into ``buckets`` buckets (replacing older versions). Rows
    are dealt by bucket first, one file each; those of the tables named in
    ``dealt`` come in that many parts by film id already."""
    for table, df in tables.as_dict().items():
        key = BUCKET_KEYS.get(table)
        if key is not None and table not in dealt:
            df = df.repartition(buckets, key)
        writer = df.write.mode("overwrite").format("parquet")
        if key is not None:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(table_name(prefix, table))


def load_bucketed(spark: SparkSession, prefix: str) -> FilmTables:
    return FilmTables(**{t: spark.table(table_name(prefix, t))
                         for t in ("film_work", "genre", "genre_film_work", "person",
                                   "person_film_work")})


@contextmanager
def bucketed(tables: FilmTables, dealt: Collection[str] = ()) -> Iterator[FilmTables]:
    """``tables`` kept in the layout while a job reads them several times: costly
    sources are evaluated once. In as many buckets as shuffles have parts, so that
    a frame that is joined by film id meets them as they lie. The tables are
    dropped at the end."""
    spark = tables.film_work.sparkSession
    tables = tables.replace(**{t: tables.as_dict()[t].select(*cols) for t, cols in LINK_COLUMNS.items()})
    prefix = f"film_tables_{uuid.uuid4().hex}"
    try:
        save_bucketed(tables, prefix, int(spark.conf.get("spark.sql.shuffle.partitions")), dealt)
        yield load_bucketed(spark, prefix)
    finally:
        for table in tables.as_dict():
            spark.sql(f"DROP TABLE IF EXISTS {table_name(prefix, table)}")
