"""Exact percentiles from value counts, with no value list held per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from wardlens.functions.numbers import whole_quotient
from wardlens.operators.keys import join_back
from wardlens.operators.sequences import along
from wardlens.sources.staging import stage


def _counted(
    df: DataFrame, keys: Sequence[str], value: str, max_group_rows: int | None
) -> DataFrame:
    """Distinct values of each group with ``_n``, ``_through`` (rows up to it) and ``_rows`` (all rows).

    The counts are staged once and serve for the group sizes, the running count and the totals.
    """
    counts = stage(
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")),
        "counts",
    )
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
    sizes = totals.select(*keys, F.col("_values").alias("_n"))
    placed = along(
        counts, keys, [value], running={"_through": ("sum", "_n")},
        max_group_rows=max_group_rows, sizes=sizes,
    )
    totals = totals.drop("_values")
    if keys:
        return join_back(placed, totals, keys, "inner")
    return placed.withColumn("_rows", totals.scalar())


def percentiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float],
    max_group_rows: int | None = None,
) -> DataFrame:
    """Continuous (interpolated) percentiles per group, or of all rows without keys.

    Rows are counted per distinct value before any sort; the running count of
    the values tells which ones stand at the wanted places.
    """
    placed = _counted(df, keys, value, max_group_rows)
    first, last = F.col("_through") - F.col("_n"), F.col("_through") - 1

    def at(place):
        return F.max(F.when(place.between(first, last), F.col(value)))

    columns = []
    for out, q in quantiles.items():
        place = (F.col("_rows") - 1) * F.lit(float(q))
        low = at(F.floor(place))
        high = at(F.ceil(place))
        share = F.max(place - F.floor(place))
        columns.append((low + (high - low) * share).alias(out))
    return placed.groupBy(*keys).agg(*columns)


def approximate_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float],
    accuracy: int = 10_000,
) -> DataFrame:
    """Percentiles from mergeable sketches of bounded size."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(value, q, accuracy).alias(out) for out, q in quantiles.items()]
    )


def median_by_rank(
    df: DataFrame, keys: Sequence[str], value: str, tie_break: str, out: str = "median",
    max_group_rows: int | None = None,
) -> DataFrame:
    """Median as the mean of the middle one or two rows of each group.

    The rows are numbered by value counts, so that ``tie_break``, which orders
    rows of one value, cannot change the result and is not read.
    """
    placed = _counted(df, keys, value, max_group_rows)
    low = whole_quotient(F.col("_rows") + 1, F.lit(2))
    high = whole_quotient(F.col("_rows") + 2, F.lit(2))
    first, last = F.col("_through") - F.col("_n") + 1, F.col("_through")

    def at(place):
        return F.max(F.when(place.between(first, last), F.col(value)))

    return placed.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias(out))
