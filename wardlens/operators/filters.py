"""Row selection that a plain ``filter`` does not name by itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def date_range(column: str, start: str, stop: str) -> Column:
    """Half-open range on the raw timestamp, so the filter reaches the Parquet scan."""
    ts = F.col(column)
    return (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(stop).cast("timestamp_ntz"))


def year_is(column: str, year: int) -> Column:
    """Timestamps of one year, as a range on the raw column."""
    return date_range(column, f"{year}-01-01", f"{year + 1}-01-01")


def equals_extreme(df: DataFrame, column: str, largest: bool = True) -> DataFrame:
    """Rows holding the largest (or smallest) value of the whole table."""
    extreme = F.max(column) if largest else F.min(column)
    return df.filter(F.col(column) == df.agg(extreme).scalar())


def within_keys(df: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``source`` (IN subquery on one or more columns).

    ``source`` is reduced to distinct keys before its shuffle, so a key repeated
    any number of times there weighs one row; a key hot in ``df`` is split by
    AQE's skew join.
    """
    return df.join(source.select(*keys).distinct(), list(keys), "left_semi")


def without_keys(df: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``source``; NULL keys on either side never match.

    Unlike SQL's NOT IN, a NULL in ``source`` does not empty the result, and a
    row with a NULL key is left out.
    """
    for key in keys:
        df, source = df.filter(F.col(key).isNotNull()), source.filter(F.col(key).isNotNull())
    return df.join(source.select(*keys).distinct(), list(keys), "left_anti")


def exists_flag(
    requested: DataFrame, source: DataFrame, keys: Sequence[str], out: str = "found"
) -> DataFrame:
    """Mark each requested key with whether ``source`` holds it.

    A semi join first cuts ``source`` to the requested keys.
    """
    hits = source.select(*keys).join(requested.select(*keys), list(keys), "left_semi")
    hits = hits.distinct().withColumn(out, F.lit(True))
    return requested.join(hits, list(keys), "left").withColumn(
        out, F.coalesce(F.col(out), F.lit(False))
    )


def above_mean(df: DataFrame, column: str, mean_out: str, where: Column | None = None) -> DataFrame:
    """Rows above the mean of the column, with that mean as a column."""
    base = df if where is None else df.filter(where)
    mean = base.agg(F.avg(column)).scalar()
    return df.withColumn(mean_out, mean).filter(F.col(column) > F.col(mean_out))


def sigma_outliers(df: DataFrame, column: str, k: float = 2.0) -> DataFrame:
    """Rows more than k population standard deviations from the mean."""
    limits = df.agg(
        F.struct(F.avg(column).alias("mean"), F.stddev_pop(column).alias("sd")).alias("s")
    ).scalar()
    return (
        df.withColumn("_limits", limits)
        .filter(F.abs(F.col(column) - F.col("_limits.mean")) > F.lit(float(k)) * F.col("_limits.sd"))
        .drop("_limits")
    )


def sharing_duplicates(df: DataFrame, same: Sequence[str], differs: str) -> DataFrame:
    """Rows that agree with some other row on ``same`` but not on ``differs``.

    Such a row exists exactly where the group's smallest and largest ``differs``
    are unequal, so no pair of rows is ever formed.
    """
    groups = (
        df.groupBy(*same)
        .agg(F.min(differs).alias("_low"), F.max(differs).alias("_high"))
        .filter(F.col("_low") != F.col("_high"))
    )
    return df.filter(F.col(differs).isNotNull()).join(
        groups.select(*same), list(same), "left_semi"
    )
