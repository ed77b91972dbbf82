"""The five film tables, and where they can be read from.

``FilmTables`` is what every job works on. It is opened from parquet folders,
from catalog tables or from a relational database; opening again gives the
tables as they are then.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RENAMES, TARGETS
from .jdbc import read_jdbc

NAMES = ("film_work", "genre", "genre_film_work", "person", "person_film_work")


@dataclass(frozen=True)
class FilmTables:
    film_work: DataFrame
    genre: DataFrame
    genre_film_work: DataFrame
    person: DataFrame
    person_film_work: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in NAMES}

    def replace(self, **frames: DataFrame) -> "FilmTables":
        return FilmTables(**{**self.as_dict(), **frames})


def _target_columns(df: DataFrame, table: str) -> DataFrame:
    """The target table's columns; source names are accepted for renamed ones."""
    old = {new: name for name, new in RENAMES.items()}
    return df.select(*[df[f.name if f.name in df.columns else old.get(f.name, f.name)].alias(f.name)
                       for f in TARGETS[table].fields])


def _open(read: Callable[[str], DataFrame]) -> FilmTables:
    return FilmTables(**{name: _target_columns(read(name), name) for name in NAMES})


def from_parquet(spark: SparkSession, root: str) -> FilmTables:
    """Folders ``<root>/<table>`` (as the copy job writes them)."""
    return _open(lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}"))


def from_catalog(spark: SparkSession, prefix: str = "") -> FilmTables:
    """Catalog tables named ``<prefix><table>``, for example ``films.``."""
    return _open(lambda name: spark.table(f"{prefix}{name}"))


def from_jdbc(spark: SparkSession, url: str, schema: str = "", **options) -> FilmTables:
    """Tables of a relational database (see ``jdbc_options``); ``schema`` such
    as ``content.`` goes before each table's name."""
    return _open(lambda name: read_jdbc(spark, url, f"{schema}{name}", **options))
