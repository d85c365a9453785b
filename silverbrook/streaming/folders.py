"""Folders of the lake, and sessions with other settings, from the driver; only names pass through it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def subfolders(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Folders that many levels below a path, relative to it; none where there is no such path."""
    store, where = _store(spark, path)
    if not store.exists(where):
        return []
    names = [s.getPath().getName() for s in store.listStatus(where) if s.isDirectory()]
    if depth == 1:
        return sorted(names)
    return [f"{name}/{below}" for name in sorted(names) for below in subfolders(spark, f"{path}/{name}", depth - 1)]


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder that a newer one has replaced."""
    store, where = _store(spark, path)
    return store.delete(where, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file below a path, or of the file."""
    store, where = _store(spark, path)
    if not store.exists(where):
        return 0
    files, most = store.listFiles(where, True), 0
    while files.hasNext():
        most = max(most, files.next().getLen())
    return most


def session_like(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """Another session of the same catalog with the caller's settings, but for some."""
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            other.conf.set(name, value)
    for name, value in settings.items():
        other.conf.set(name, value)
    return other


def moved(rows: DataFrame, settings: dict[str, str]) -> DataFrame:
    """The same rows, planned by a session with other settings; the caller's session stays as it is."""
    other, name = session_like(rows.sparkSession, settings), f"moved_{uuid.uuid4().hex}"
    rows.createGlobalTempView(name)
    try:
        return other.table(f"global_temp.{name}")
    finally:
        rows.sparkSession.catalog.dropGlobalTempView(name)


def listing_session(spark: SparkSession) -> SparkSession:
    """A session of the same catalog whose new tables find their partitions by listing folders.

    The setting is read when a table is made, and the caller's session stays as it is.
    """
    return session_like(spark, {"spark.sql.hive.manageFilesourcePartitions": "false"})
