"""Joining a result back to its rows by group key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def join_back(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in GROUP BY.

    ``right`` has one row per key, so a hot key on the left is split by AQE's
    skew join; AQE also turns the join into a broadcast when the measured size
    of ``right`` allows it.
    """
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    joined = left.join(renamed, same_keys(keys), how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def same_keys(keys: Sequence[str], prefix: str = "_r_") -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]
    )
