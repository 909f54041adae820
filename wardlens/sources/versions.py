"""Tables that are replaced under their readers.

A table is a folder of versions, each written whole to a folder of its own.  A version counts from
the moment its empty marker file exists; creating a file is atomic on every file system Spark
writes to.  So a reader sees one version from start to end, a load that fails leaves the last one
in place, and a query may read the table that it replaces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wardlens.sources.staging import delete_path

_DATA, _MARKS = "versions", "committed"


def _names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder in order, none if the folder is missing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def committed(spark: SparkSession, root: str) -> list[str]:
    """Names of the table's whole versions, oldest first."""
    return _names(spark, f"{root}/{_MARKS}")


def replace_table(df: DataFrame, root: str) -> DataFrame:
    """Write a query as the table's next version and return the scan of that version.

    Of loads that run at once each writes a version of its own; the one that started last stands.
    """
    spark = df.sparkSession
    last = _names(spark, f"{root}/{_DATA}")
    number = int(last[-1].split("-")[0]) + 1 if last else 1
    name = f"{number:012d}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{root}/{_DATA}/{name}")
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{_MARKS}/{name}")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, False).close()
    return spark.read.schema(df.schema).parquet(f"{root}/{_DATA}/{name}")


def open_table(spark: SparkSession, root: str, back: int = 0) -> DataFrame:
    """Scan the current version, or the one ``back`` versions before it."""
    names = committed(spark, root)
    if len(names) <= back:
        raise ValueError(f"{root} has {len(names)} versions")
    return spark.read.parquet(f"{root}/{_DATA}/{names[-1 - back]}")


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` versions, and return their names.

    What stands below the oldest kept version goes, failed loads included.  A marker goes before its data,
    so no reader opens a version that is being deleted; readers and loads that started before that version
    must have finished.
    """
    if keep < 1:
        raise ValueError("at least one version stays")
    names = committed(spark, root)
    if not names:
        return []
    oldest = names[-keep:][0]
    gone = [name for name in _names(spark, f"{root}/{_DATA}") if name < oldest]
    for name in gone:
        delete_path(spark, f"{root}/{_MARKS}/{name}")
        delete_path(spark, f"{root}/{_DATA}/{name}")
    return gone
