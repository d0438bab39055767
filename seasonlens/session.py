"""Session defaults and the shared staging folder."""

from __future__ import annotations

import uuid
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when a later window has to shuffle again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: by application, what ``stage`` has persisted in sessions without a shared folder
_persisted: dict[str, list[DataFrame]] = {}
#: where ``stage`` has written a table in the shared folder
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: applications whose Python workers have this package
_shared: set[str] = set()


def with_defaults(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Let the optimizer split skewed join sides in a session that was made elsewhere."""
    for key in DEFAULTS:
        if "skew" in key.lower():
            spark.conf.set(key, DEFAULTS[key])
    return spark


def share_package(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package, from wherever the driver loaded it.

    On a cluster the package is part of the executors' environment or shipped with the application.
    """
    context = spark.sparkContext
    if context._jsc.sc().isLocal() and context.applicationId not in _shared:
        _shared.add(context.applicationId)
        context.addFile(str(Path(__file__).resolve().parent), recursive=True)


def staging_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``; None if the session names none."""
    return spark.conf.get("spark.checkpoint.dir", None)


def _folder(spark: SparkSession, shared: str) -> str:
    return f"{shared.rstrip('/')}/staged-{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """``df`` computed once, for tables that several jobs read.

    With a shared folder it is written there as Parquet and read back: the lineage is cut, a lost
    executor costs nothing that was already written, and later reads prune columns. Without one it
    is persisted in the executors, which compute lost blocks again. ``release`` removes both. ``rows_per_file``
    is for few and large rows that are to be dealt to tasks one by one; 0 is no limit.
    """
    spark = df.sparkSession
    shared = staging_dir(spark)
    if not shared:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        _persisted.setdefault(spark.sparkContext.applicationId, []).append(kept)
        return kept
    path = f"{_folder(spark, shared)}/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _written[staged] = path
    return staged


def unstage(df: DataFrame | None) -> None:
    """Remove what ``stage`` has written for ``df``, once all tables made of it are staged themselves.

    Other tables, and those that are persisted, stay: without a shared folder nothing is computed before it is read.
    """
    path = _written.pop(df, None) if df is not None else None
    if path:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for files that a caller writes in its own format: in the shared folder, or else the warehouse."""
    shared = staging_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{_folder(spark, shared)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove everything this application has staged; call it when results have been used."""
    for kept in _persisted.pop(spark.sparkContext.applicationId, []):
        kept.unpersist()
    jvm = spark.sparkContext._jvm
    for shared in {staging_dir(spark), spark.conf.get("spark.sql.warehouse.dir")} - {None}:
        path = jvm.org.apache.hadoop.fs.Path(_folder(spark, shared))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
