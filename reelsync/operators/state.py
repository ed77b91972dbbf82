"""S-9 / F-7: progress positions as a small append-only table.

Each pass appends one row per entity ``(entity, position, pass_id)``; the
current state is the row of the latest pass per entity (a shallow merge in
which the newer pass wins). Positions are written only after the sink has
committed, so a crash in between repeats a pass instead of losing it (D-10);
the keyed upsert makes the repeat harmless.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import HIGH_WATER
from ..session import list_names, path_exists, remove_path


def empty_positions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HIGH_WATER)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """All saved rows; an absent table means nothing was ever run."""
    if not path_exists(spark, path):
        return empty_positions(spark)
    return spark.read.schema(HIGH_WATER).parquet(path)


def merge_positions(old: DataFrame, new: DataFrame) -> DataFrame:
    """F-7: one row per entity, the one of the highest ``pass_id``."""
    both = old.select(*HIGH_WATER.fieldNames()).unionByName(new.select(*HIGH_WATER.fieldNames()))
    latest = both.groupBy("entity").agg(
        F.max_by(F.struct("position", "pass_id"), "pass_id").alias("s"))
    return latest.select("entity", F.col("s.position").alias("position"),
                         F.col("s.pass_id").alias("pass_id"))


def positions_of(highs: DataFrame, pass_id: int) -> DataFrame:
    """Rows to save after a pass: ``highs`` is ``(entity, position)``, without zone."""
    return highs.select(F.col("entity"), F.col("position").cast("timestamp_ntz"),
                        F.lit(pass_id).cast("long").alias("pass_id"))


#: Files of saved rows beyond which they are merged into one.
FILES = 64


def save_positions(df: DataFrame, path: str) -> None:
    """Append the pass's rows; small, so written as a single file. Where many
    files have gathered, their latest rows are appended once more and the files
    before them removed: a crash in between leaves repeated rows, which merge to
    the same state."""
    spark = df.sparkSession
    old = [n for n in list_names(spark, path) if n.endswith(".parquet")]
    rows = df.select(*HIGH_WATER.fieldNames())
    if len(old) > FILES:
        rows = merge_positions(read_positions(spark, path), rows)
    rows.coalesce(1).write.mode("append").parquet(path)
    if len(old) > FILES:
        for name in old:
            remove_path(spark, f"{path}/{name}")


STATE_JSON_SCHEMA = "map<string, string>"


def state_json(current: DataFrame) -> DataFrame:
    """F-5 / F-6: the current positions as one JSON object of ISO-8601 texts
    (``{"genre": "2024-01-30T20:00:00.000000", ...}``), NULL for never run.
    One row per entity goes in, so the list is bounded by the entity count."""
    entry = F.struct(F.col("entity"), F.date_format("position", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return current.agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("state"))


def positions_from_json(state: DataFrame, pass_id: int = 0) -> DataFrame:
    """F-6: the inverse of :func:`state_json`, as position rows."""
    parsed = state.select(F.explode(F.from_json("state", STATE_JSON_SCHEMA)).alias("entity", "iso"))
    return parsed.select("entity", F.to_timestamp_ntz("iso").alias("position"),
                         F.lit(pass_id).cast("long").alias("pass_id"))


def as_dict(current: DataFrame) -> dict[str, dt.datetime | None]:
    """The current positions on the driver: one row per entity (bounded)."""
    return {r["entity"]: r["position"] for r in current.collect()}


#: Fixed value: the zone of the reference's wall-clock times, three hours ahead
#: of UTC whatever the season (the sign in this name is the other way round).
ZONE = "Etc/GMT-3"


def to_zone(current: DataFrame, zone: str = ZONE) -> DataFrame:
    """F-8: the positions with ``local``, their ISO text in a zone. A position
    stays the instant it is; neither the driver's nor the session's zone matters."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("position"))
    return current.withColumn("local", F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def from_zone(texts: DataFrame, zone: str = ZONE) -> DataFrame:
    """The inverse: positions from ``entity`` and ``local`` texts of a zone, as
    state written by a process on that zone's clock holds them."""
    position = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.to_timestamp_ntz("local"))
    return texts.select("entity", position.alias("position"))
