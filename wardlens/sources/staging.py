"""Durable intermediate tables.

A staged table is written to the folder named by ``spark.checkpoint.dir`` (a
shared, replicated store on a cluster), so it survives the loss of executors
and cuts the lineage of everything built on it.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_roots: dict[str, str] = {}
_open_contexts: list[list[str]] = []


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables; a local one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="wardlens-")
    return _local_roots[app]


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the staging root, grouped by application for clean-up."""
    app = spark.conf.get("spark.app.id", "local")
    path = f"{staging_root(spark)}/wardlens/{app}/{label}-{uuid.uuid4().hex}"
    for paths in _open_contexts:
        paths.append(path)
    return path


@contextlib.contextmanager
def staged(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted when the context closes, so results must be read before.

    Without it they stay until the application's folder is removed.
    """
    paths: list[str] = []
    _open_contexts.append(paths)
    try:
        yield
    finally:
        _open_contexts.remove(paths)
        for path in paths:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder on any of Spark's file systems; nothing happens if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(table: DataFrame) -> None:
    """Delete a staged table that nothing reads any more, or any scan or selection of it."""
    for path in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        if f"/wardlens/{table.sparkSession.conf.get('spark.app.id', 'local')}/" in path:
            delete_path(table.sparkSession, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a query result as a table and return the scan of that table."""
    path = staging_path(df.sparkSession, label)
    return save_table(df, path)


def stage_lean(df: DataFrame, label: str) -> DataFrame:
    """As ``stage``, with the shuffle files of the query deleted as soon as it is written.

    For the rounds of an iteration: else each round's files stay until the driver's garbage collector
    finds that nothing refers to its plan.  The session's own setting is put back after the write.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return stage(df, label)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Create a table from a query, replacing what the path held before."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
