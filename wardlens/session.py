"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "wardlens",
    **extra: str,
) -> SparkSession:
    """A session with UTC time, ANSI SQL and adaptive execution.

    On a cluster leave ``master`` to spark-submit, and size
    ``shuffle_partitions`` so that one partition fits an executor core's memory.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
