"""Set operations on whole rows, columns matched by name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right)


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows on both sides; copies are dropped before the shuffle of the join."""
    return left.select(*right.columns).distinct().intersect(right.distinct())


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left side that the right side lacks."""
    return left.select(*right.columns).distinct().subtract(right.distinct())
