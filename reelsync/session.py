"""Session settings and the shared folder for lineage cuts and job state.

The library never sets cluster configuration behind the caller's back. Where
no checkpoint folder is named, it uses one below the session's warehouse, which
all machines share; it never names a folder of one machine.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings for sessions this package creates itself (tests, bench, examples).
# Everything Catalyst and AQE can decide at run time is left to them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "reelsync",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - some keys are not readable on every session
        return None


def _context(spark: SparkSession):
    """The SparkContext of a classic session, ``None`` where there is none."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, read from the
    session; where it is unset, a folder below ``spark.sql.warehouse.dir``."""
    sc = _context(spark)
    root = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    root = root or _conf(spark, "spark.checkpoint.dir")
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the checkpoint root; ``unique`` appends a fresh run id."""
    path = "/".join([checkpoint_root(spark), "reelsync", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable (reliable, never local)."""
    checkpoint_root(spark)


def checkpoint_frame(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint. Its files go when
    the frame is no longer used if the session sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _store(spark: SparkSession, path: str):
    """Hadoop's path and file system for ``path``, on whatever store it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists."""
    target, store = _store(spark, path)
    return store.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote (an expired version, a finished job's state)."""
    target, store = _store(spark, path)
    store.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (an absent one has none)."""
    target, store = _store(spark, path)
    return [f.getPath().getName() for f in store.listStatus(target)] if store.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    target, store = _store(spark, path)
    stream = store.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file under ``path`` unless it exists; whether it was
    written. The finished file is renamed into place, so readers never see a
    part of it, and a rename does not replace a file that is there."""
    jvm = spark.sparkContext._jvm
    target, store = _store(spark, path)
    folder, name = path.rsplit("/", 1)
    draft, _ = _store(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    none = spark.sparkContext._gateway.new_array(kind, 1)
    none[0] = kind.NONE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        store.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(store.makeQualified(draft), store.makeQualified(target), none)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    finally:
        store.delete(draft, False)
