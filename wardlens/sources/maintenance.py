"""Table changes as pure functions: each returns the changed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def check_split(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Rows a checked view would accept, and the rest (false or NULL)."""
    ok = F.coalesce(rule, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def append_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows that may name fewer columns; the missing ones become NULL."""
    return df.unionByName(rows, allowMissingColumns=True).select(*df.columns)


def parent_scan(parent: DataFrame, *children: DataFrame) -> DataFrame:
    """Scan a parent table with its children, seen through the parent's columns."""
    out = parent
    for child in children:
        out = out.unionByName(child.select(*parent.columns))
    return out


def family_scan(parent: DataFrame, *children: DataFrame) -> DataFrame:
    """Scan a parent table with its children, keeping the children's extra columns."""
    out = parent
    for child in children:
        out = out.unionByName(child, allowMissingColumns=True)
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; pruned before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_pick", rank).filter(F.col("_pick") == 1).drop("_pick")


def update_from(
    df: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    column: str,
    new_value: Column,
    order: Sequence[Column],
) -> DataFrame:
    """Set ``column`` from a matching source row; rows without a match keep theirs.

    ``order`` decides between several source rows of one key.
    """
    source = latest_per_key(source, keys, order).withColumn("_new", new_value)
    matched = df.join(source.select(*keys, "_new", F.lit(True).alias("_hit")), list(keys), "left")
    return matched.withColumn(
        column, F.when(F.col("_hit"), F.coalesce("_new", column)).otherwise(F.col(column))
    ).select(*df.columns)


def add_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace computed columns in one projection."""
    return df.withColumns(columns)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Remove columns; a name that is not there is ignored."""
    return df.drop(*columns)
