"""The link tables kept a second time, by entity: which films a person or a
genre is linked to, without reading all links (J-5).

A link's place is a hash of its entity's id; the index is partitioned by place
and sorted by the id inside. A lookup finds the places of the changed ids (at
most ``places`` numbers, the one thing that reaches the driver) and reads only
those folders, so its cost follows the changed ids. A film id that several link
rows give is kept once per entity and build.

Links are appended by ``add`` as they arrive; a removed link is taken out by
``build``, which writes the index anew in a folder of its own and then makes
that the current one, so that readers keep a whole index.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import list_names, publish_text, read_text, remove_path
from .film import FilmTables

PLACE = "__place"
PLACES = 64  # of a new index
# Link table and its entity column, per entity.
LINKS = {"person": ("person_film_work", "person_id"), "genre": ("genre_film_work", "genre_id")}


@dataclass(frozen=True)
class LinkIndex:
    """The index below ``root`` (shared storage)."""

    root: str
    places: int = PLACES

    def _place(self, col: Column) -> Column:
        # as text: an id has one place whatever its type
        return F.pmod(F.xxhash64(col.cast("string")), F.lit(self.places)).cast("int")

    def _rows(self, links: DataFrame, entity: str) -> DataFrame:
        """What the index keeps of link rows; those without both ids lead nowhere."""
        rows = links.select(F.col(LINKS[entity][1]).alias("entity_id"), F.col("film_work_id").alias("id"))
        rows = rows.where(F.col("entity_id").isNotNull() & F.col("id").isNotNull()).distinct()
        return rows.withColumn(PLACE, self._place(F.col("entity_id")))

    def _write(self, links: DataFrame, entity: str, folder: str) -> None:
        # dealt by place and film, so that an entity with a third of all links is
        # written by several tasks; sorted, so that row groups tell ids apart
        (self._rows(links, entity).hint("rebalance", PLACE).sortWithinPartitions(PLACE, "entity_id")
         .write.mode("append").partitionBy(PLACE).parquet(folder))

    def _builds(self, spark: SparkSession) -> list[int]:
        return sorted(int(n[:-5]) for n in list_names(spark, f"{self.root}/_builds") if n.endswith(".json"))

    def _current(self, spark: SparkSession) -> dict:
        build = json.loads(read_text(spark, f"{self.root}/_builds/{self._builds(spark)[-1]:08d}.json"))
        if build["places"] != self.places:
            raise ValueError(f"{self.root} has {build['places']} places")
        return build

    def build(self, tables: FilmTables, keep: int = 2) -> None:
        """Write the index of all links and make it the current one; builds before
        the last ``keep`` are removed."""
        spark = tables.film_work.sparkSession
        known, folder = self._builds(spark), f"build-{uuid.uuid4().hex}"
        schemas = {}
        for entity, (table, _) in LINKS.items():
            links = tables.as_dict()[table]
            schemas[entity] = self._rows(links, entity).drop(PLACE).schema.json()
            self._write(links, entity, f"{self.root}/{folder}/{entity}")
        number = (known[-1] if known else 0) + 1
        if not publish_text(spark, f"{self.root}/_builds/{number:08d}.json",
                            json.dumps({"folder": folder, "places": self.places, "schemas": schemas})):
            remove_path(spark, f"{self.root}/{folder}")
            raise RuntimeError(f"{self.root}: another build was finished first")
        for old in known[:-(keep - 1)] if keep > 1 else known:
            name = f"{self.root}/_builds/{old:08d}.json"
            remove_path(spark, f"{self.root}/{json.loads(read_text(spark, name))['folder']}")
            remove_path(spark, name)

    def add(self, links: DataFrame, entity: str) -> None:
        """Append new link rows of an entity."""
        self._write(links, entity, f"{self.root}/{self._current(links.sparkSession)['folder']}/{entity}")

    def linked_film_ids(self, changed: DataFrame, entity: str) -> DataFrame:
        """Film ids linked to the ids in ``changed`` (column ``id``; used twice, so
        hand in a written frame where it is costly), as column ``id``, may repeat."""
        spark = changed.sparkSession
        keys = changed.select(F.col("id").alias("__changed"))
        wanted = [r[0] for r in keys.select(self._place(F.col("__changed"))).where(F.col("__changed").isNotNull())
                  .distinct().collect()]  # at most one row per place
        build = self._current(spark)
        folder, schema = f"{self.root}/{build['folder']}/{entity}", T.StructType.fromJson(json.loads(build["schemas"][entity]))
        known = set(list_names(spark, folder))
        read = [f"{folder}/{PLACE}={p}" for p in sorted(wanted) if f"{PLACE}={p}" in known]
        rows = spark.read.schema(schema).parquet(*read) if read else spark.createDataFrame([], schema)
        return rows.join(keys, rows["entity_id"] == keys["__changed"], "left_semi").select("id")
