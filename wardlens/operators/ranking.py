"""Ranks over a whole table and top rows per group, balanced under ties and skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlens.functions.numbers import whole_quotient
from wardlens.operators.keys import join_back
from wardlens.operators.sequences import add_range_starts, numbered, placed_in_ranges


def surrogate_key(df: DataFrame, order: Sequence[Column | str], out: str = "row_no") -> DataFrame:
    """Serial number 1..N by a unique order."""
    return numbered(df, *order, out=out)


def ntile(df: DataFrame, order: Sequence[Column | str], tiles: int, out: str) -> DataFrame:
    """Tile 1..tiles by a unique order; the first tiles take the spare rows."""
    rows = numbered(df, *order, out="_no")
    total = rows.agg(F.max("_no")).scalar()
    size, spare = whole_quotient(total, F.lit(tiles)), total % F.lit(tiles)
    number, edge = F.col("_no"), spare * (size + 1)
    tile = F.when(number <= edge, whole_quotient(number - 1, size + 1) + 1).otherwise(
        spare + whole_quotient(number - edge - 1, F.greatest(size, F.lit(1))) + 1
    )
    return rows.withColumn(out, tile.cast("int")).drop("_no")


def global_rank(
    df: DataFrame,
    columns: Sequence[str],
    descending: Sequence[bool],
    out: str = "rank",
    dense: bool = False,
) -> DataFrame:
    """RANK or DENSE_RANK of all rows by several columns, NULLs ranked last.

    Rows are first counted per distinct value, so a value shared by a third of
    the table is one row from then on.  The distinct values are range-sorted over
    the cluster, and the rows counted before a value make its rank.
    """
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    order = [
        F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last()
        for c, down in zip(columns, descending)
    ]
    placed = placed_in_ranges(counts, *order)
    if dense:
        ranked = add_range_starts(placed, _start=F.count(F.lit(1))).withColumn(
            out, F.col("_start") + F.col("_seq_within") + 1
        )
    else:
        earlier = (
            Window.partitionBy("_seq_range")
            .orderBy("_seq_within")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        ranked = add_range_starts(placed, _start=F.sum("_n")).withColumn(
            out, F.col("_start") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1
        )
    return join_back(df, ranked.select(*columns, out), columns, "inner").select(*df.columns, out)


def top_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str = "row_no"
) -> DataFrame:
    """The first n rows per group by a unique order.

    Spark keeps only n rows per group and map task before the shuffle
    (WindowGroupLimit), so a hot group costs no more than any other.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, number).filter(F.col(out) <= n)


def top_values(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    n: int = 1,
    out: str = "rank",
    dense: bool = False,
    ascending: bool = False,
) -> DataFrame:
    """All rows whose value ranks within n in their group, ties included.

    The ranking runs on at most n distinct values per group; the rows holding
    them, however many tie, are then picked by an equi-join.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    order = F.col(value).asc() if ascending else F.col(value).desc()
    window = Window.partitionBy(*keys).orderBy(order)
    best = counts.withColumn("_dense", F.row_number().over(window)).filter(F.col("_dense") <= n)
    if dense:
        best = best.withColumn(out, F.col("_dense"))
    else:
        through = window.rowsBetween(Window.unboundedPreceding, -1)
        best = best.withColumn(
            out, (F.coalesce(F.sum("_n").over(through), F.lit(0)) + 1).cast("int")
        ).filter(F.col(out) <= n)
    return join_back(df, best.select(*keys, value, out), [*keys, value], "inner")


def rows_at_last_time(
    df: DataFrame, keys: Sequence[str], time: str, tie_break: Sequence[Column], limit: int | None = None
) -> DataFrame:
    """All rows at each group's latest time, or the first ``limit`` of them by ``tie_break``."""
    last = df.filter(F.col(time).isNotNull()).groupBy(*keys).agg(F.max(time).alias("_last"))
    rows = join_back(df, last, keys, "inner").filter(F.col(time) == F.col("_last")).drop("_last")
    if limit is None:
        return rows
    return top_rows(rows, keys, list(tie_break), limit, "_no").drop("_no")


def nth_distinct(df: DataFrame, column: str, n: int, ascending: bool = True) -> DataFrame:
    """All rows holding the n-th distinct value of a column."""
    order = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    value = (
        df.filter(F.col(column).isNotNull()).select(column).distinct()
        .orderBy(order).offset(n - 1).limit(1)
    )
    return df.filter(F.col(column) == value.scalar())


def most_frequent(
    df: DataFrame, keys: Sequence[str], column: str, out: str = "n", ties: bool = False,
    least: bool = False,
) -> DataFrame:
    """The most (or least) frequent value per group; all of them with ``ties``.

    Without ``ties`` the smallest value wins.
    """
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias(out))
    if ties:
        return top_values(counts, keys, out, 1, "_rank", ascending=least).drop("_rank")
    sign = F.col(out) if least else -F.col(out)
    best = F.min(F.struct(sign.alias("_sign"), F.col(column), F.col(out))).alias("_best")
    return counts.groupBy(*keys).agg(best).select(*keys, f"_best.{column}", f"_best.{out}")
