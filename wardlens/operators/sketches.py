"""Stored sketches: percentiles over periods and distinct counts of combined sets, without the rows.

A sketch is a binary column of bounded size that Spark builds map-side and merges.  Stored once per
group and period, sketches answer for any span of periods by merging a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Values a percentile sketch keeps at its top level: groups up to that size are exact, larger ones have
#: a rank error of about 2.3 / k (0.06 %) with 99 %.
PERCENTILE_K = 4096
#: Doublings of the hashes a set sketch keeps: up to 2^16 distinct values are counted exactly, more with
#: a standard error of 1 / sqrt(2^16) (0.4 %) of the larger set.
SET_DOUBLINGS = 16


def period_sketches(
    df: DataFrame, keys: Sequence[str], time: str, value: str, period: str = "month", k: int = PERCENTILE_K
) -> DataFrame:
    """One percentile sketch per group and period: the keys, ``period`` (its first instant), ``sketch``.

    NULL values don't count; a group and period of only NULLs has an empty sketch.  Rows without a time
    have the period NULL.
    """
    return df.groupBy(*keys, F.date_trunc(period, F.col(time)).alias("period")).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")
    )


def merged_percentiles(
    sketches: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float], k: int = PERCENTILE_K
) -> DataFrame:
    """Percentiles of each group over the periods given: the keys, ``n`` (values) and one column each.

    A percentile is the smallest value that at least that share of the values don't exceed.  A group
    without values has ``n`` 0 and NULL percentiles.
    """
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("_sketch"))
    counted = merged.withColumn("n", F.kll_sketch_get_n_double("_sketch"))
    columns = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q)))).alias(out)
        for out, q in quantiles.items()
    ]
    return counted.select(*keys, "n", *columns)


def rank_in_sketches(sketches: DataFrame, keys: Sequence[str], value: float, k: int = PERCENTILE_K) -> DataFrame:
    """The share of each group's values that are at most ``value``: the keys, ``n``, ``share``."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("_sketch"))
    counted = merged.withColumn("n", F.kll_sketch_get_n_double("_sketch"))
    share = F.when(F.col("n") > 0, F.kll_sketch_get_rank_double("_sketch", F.lit(float(value))))
    return counted.select(*keys, "n", share.alias("share"))


def set_sketches(
    df: DataFrame, keys: Sequence[str], member: str, sets: Mapping[str, Column], doublings: int = SET_DOUBLINGS
) -> DataFrame:
    """One column per named condition with the sketch of the members that meet it, from one scan.

    A member is in a set if any of its rows meets the condition; NULL members are in none.
    """
    return df.groupBy(*keys).agg(
        *[F.theta_sketch_agg(F.when(condition, F.col(member)), doublings).alias(out) for out, condition in sets.items()]
    )


def members(sketch: Column) -> Column:
    """Number of members of a set sketch, as a long."""
    return F.theta_sketch_estimate(sketch).cast("long")


def both(a: Column, b: Column) -> Column:
    """Sketch of the members of both sets."""
    return F.theta_intersection(a, b)


def only(a: Column, b: Column) -> Column:
    """Sketch of the members of the first set that are not in the second."""
    return F.theta_difference(a, b)


def either(a: Column, b: Column, doublings: int = SET_DOUBLINGS) -> Column:
    """Sketch of the members of either set."""
    return F.theta_union(a, b, doublings)


def merged_sets(sketches: DataFrame, keys: Sequence[str], names: Sequence[str], doublings: int = SET_DOUBLINGS) -> DataFrame:
    """Set sketches of finer groups united into those of ``keys``."""
    return sketches.groupBy(*keys).agg(*[F.theta_union_agg(name, doublings).alias(name) for name in names])
