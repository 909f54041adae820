"""Rows written in the query itself, and number series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A relation from literal rows; its size is the size of the query text."""
    return spark.createDataFrame(list(rows), schema)


def expand_series(df: DataFrame, start: Column, stop: Column, step: Column, out: str) -> DataFrame:
    """One row per element of the series start, start+step, ... up to stop of each row.

    A row whose series is empty, because the step leads away from stop or a part is NULL, gives
    no rows; a step of 0 is an error.
    """
    leads = (stop - start) * F.sign(step) >= 0
    return df.withColumn(out, F.explode(F.when(leads, F.sequence(start, stop, step))))


def series_quotient(start: Column, stop: Column, step: Column) -> Column:
    """Whole-number quotient (stop - start) / step: the series' elements less one, NULL if it has none."""
    leads = (stop - start) * F.sign(step) >= 0
    return F.when(leads & (step != 0), F.call_function("div", stop - start, step))
