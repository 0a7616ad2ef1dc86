"""Sessions and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# While it is set, Spark deletes the shuffle files of a query when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders of the owners that are open, the innermost last.
_owned: list[str] = []
# Folders that a caller has named, the valid one last.
_named: list[str] = []


def get_session(app_name: str = "nearkin") -> SparkSession:
    """The active session, else a new one with settings from spark-defaults or spark-submit."""
    return SparkSession.getActiveSession() or SparkSession.builder.appName(app_name).getOrCreate()


def use_folder(folder: str) -> None:
    """Name the folder for intermediate tables of sessions that name none themselves."""
    _named.append(folder)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for intermediate tables; all executors must share it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or (_named[-1] if _named else None)
    if not folder:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share, or call use_folder")
    return folder.rstrip("/")


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[str]:
    """Own the intermediate tables written inside the block; leaving it deletes them.

    Results are read from these tables, so use or write them before the block ends.
    """
    folder = f"{shared_folder(spark)}/owned-{uuid.uuid4().hex}"
    _owned.append(folder)
    try:
        yield folder
    finally:
        _owned.remove(folder)
        delete_folder(spark, folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, or in that of the open owner, that no other call returns."""
    folder = _owned[-1] if _owned else shared_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries inside the block leave no shuffle files; else they stay until the driver collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``stored`` under a path from ``scratch_path``, which may be that of an owner further out."""
    with _shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The table is computed once for all its readers, outlives lost executors, and has a known
    size, by which Spark decides whether a join may broadcast it. What was shuffled for it goes.
    """
    return stored_at(df, scratch_path(df.sparkSession, name))
