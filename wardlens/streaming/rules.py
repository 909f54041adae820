"""Insert-time alert rule as a row-wise transformation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def flag_rows(df: DataFrame, rule: Column, message: str, out: str = "alert") -> DataFrame:
    """Add the warning text to rows that satisfy the rule, NULL to the others."""
    return df.withColumn(out, F.when(rule, F.lit(message)))


def only_alerts(df: DataFrame, rule: Column, message: str, out: str = "alert") -> DataFrame:
    """The rows the rule warns about; usable on a batch or a stream."""
    return flag_rows(df.filter(rule), rule, message, out)


def stream_alerts(
    spark: SparkSession, files: str, schema: StructType, rule: Column, message: str, path: str
) -> DataFrame:
    """Apply the rule to all files that have arrived and return all warnings so far.

    ``files`` is a pattern of a table's files or folder, as ``/data/events.parque[t]``: a pattern
    finds a single file as well as a folder of parts.  ``path``, in storage that all executors
    share, keeps the query's progress and its output, so that a later run with the same path
    reads only what is new.
    """
    arriving = spark.readStream.schema(schema).parquet(files)
    alerts = only_alerts(arriving, rule, message)
    query = (
        alerts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{path}/rows")
