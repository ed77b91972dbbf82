"""The version log of a stored table: one small JSON file per version.

A version names, per bucket, the folders that hold its rows: a base and the
changes laid over it since. The newest file is the table. A version is
published by renaming a finished file to its number, which fails if that number
is taken (an atomic step on HDFS and on local disks), so of two writers that
build the same version exactly one succeeds and the other learns of it; each
has written to a folder of its own, so nothing of the winner's is touched.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..session import list_names, publish_text, read_text, remove_path

LOG = "_versions"
BUCKET = "__bucket"


class ConcurrentWrite(RuntimeError):
    """Another writer committed the version this write was building."""


@dataclass(frozen=True)
class Version:
    """``layers[bucket]`` lists ``[folder, rows, version]``, the base first."""

    number: int
    schema: str
    key: list[str]
    order: list[str]
    layers: list[list[list]] = field(default_factory=list)

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def with_layers(self, layers: list[list[list]]) -> "Version":
        return replace(self, layers=layers)


def new_folder(number: int) -> str:
    """A folder name that no other attempt at any version has."""
    return f"v={number:08d}-{uuid.uuid4().hex}"


def bucket_path(path: str, folder: str, bucket: int) -> str:
    return f"{path}/data/{folder}/{BUCKET}={bucket}"


def _file(path: str, number: int) -> str:
    return f"{path}/{LOG}/{number:08d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Published versions still in the log, oldest first."""
    return sorted(int(n[:-5]) for n in list_names(spark, f"{path}/{LOG}") if n.endswith(".json"))


def load(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, the newest by default (``None``: there is none)."""
    if number is None:
        known = numbers(spark, path)
        if not known:
            return None
        number = known[-1]
    return Version(**json.loads(read_text(spark, _file(path, number))))


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Make ``version`` the newest; raises if its number is taken or gone by."""
    known = numbers(spark, path)
    expected = known[-1] + 1 if known else 1
    if version.number != expected or not publish_text(spark, _file(path, version.number), json.dumps(asdict(version))):
        raise ConcurrentWrite(f"{path}: version {version.number} was committed by another writer")


def expire(spark: SparkSession, path: str, keep: int) -> None:
    """Remove the versions before the last ``keep`` with the bucket folders that
    none of these uses."""
    known = numbers(spark, path)
    old, kept = known[:-keep], known[-keep:]
    if not old:
        return
    used = {(b, layer[0]) for n in kept for b, layers in enumerate(load(spark, path, n).layers) for layer in layers}
    held = {(b, layer[0]) for n in old for b, layers in enumerate(load(spark, path, n).layers) for layer in layers}
    for bucket, folder in sorted(held - used):
        remove_path(spark, bucket_path(path, folder, bucket))
    for folder in sorted({f for _, f in held - used}):
        if not any(n.startswith(BUCKET) for n in list_names(spark, f"{path}/data/{folder}")):
            remove_path(spark, f"{path}/data/{folder}")
    for n in old:
        remove_path(spark, _file(path, n))

