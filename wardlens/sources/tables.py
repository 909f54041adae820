"""Table scans and named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan one Parquet table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a query under a name and return the scan of that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
