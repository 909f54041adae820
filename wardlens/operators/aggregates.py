"""Grouped and whole-table aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardlens.functions.numbers import guarded_ratio, percent, round_half_up, whole_quotient
from wardlens.operators.percentiles import percentiles
from wardlens.operators.sequences import along
from wardlens.sources.staging import stage


def share_of_total(
    df: DataFrame, keys: Sequence[str], where: Column | None = None, out: str = "pct",
    digits: int = 2,
) -> DataFrame:
    """Percentage of all rows per group; ``where`` limits the groups, not the total.

    The counts are staged, so that the input is read once for them and their total.
    """
    hits = F.count(F.lit(1)) if where is None else count_where(where)
    counts = stage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"), hits.alias("n")), "shares")
    total = counts.agg(F.sum("_all")).scalar()
    return counts.filter("n > 0").withColumn(out, percent(F.col("n"), total, digits)).drop("_all")


def share_of_counted(
    df: DataFrame, keys: Sequence[str], out: str = "pct", digits: int = 2
) -> DataFrame:
    """Percentage of all grouped rows per group, the total taken from the group counts."""
    counts = stage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "shares")
    return counts.withColumn(out, percent(F.col("n"), counts.agg(F.sum("n")).scalar(), digits))


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition is true."""
    return F.count(F.when(condition, F.lit(1)))


def distinct_count(column: Column | str, relative_error: float | None = None) -> Column:
    """Number of distinct values, exact or as a sketch with the given relative error."""
    if relative_error is None:
        return F.count_distinct(column)
    return F.approx_count_distinct(column, relative_error)


def rate_where(condition: Column, digits: int = 2) -> Column:
    """Percentage of a group's rows for which the condition is true."""
    return percent(count_where(condition), F.count(F.lit(1)), digits)


def group_rate(
    df: DataFrame, keys: Sequence[str], condition: Column, out: str = "rate", digits: int = 2
) -> DataFrame:
    """Rows, rows satisfying the condition, and their percentage per group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        count_where(condition).alias("hits"),
        rate_where(condition, digits).alias(out),
    )


def exact_mean(column: Column, digits: int, scale: int) -> Column:
    """Mean of amounts with up to ``scale`` decimals, rounded; the same for any order of addition.

    A sum of doubles depends on the order in which tasks finish, which shows
    where the mean lies on the edge between two roundings.
    """
    exact = column.cast(f"decimal({min(38, 22 + scale)},{scale})")
    return round_half_up(F.try_divide(F.sum(exact).cast("double"), F.count(exact)), digits)


def count_ratio(top: Column, bottom: Column) -> Column:
    """Rows satisfying one condition per row satisfying another; NULL for none."""
    return guarded_ratio(count_where(top), count_where(bottom))


def correlation(y: Column, x: Column) -> Column:
    """Pearson correlation over rows where both are present.

    NULL for fewer than two rows or no variance, where Spark's ``corr`` fails
    under ANSI rules.
    """
    both = y.isNotNull() & x.isNotNull()
    y, x = F.when(both, y.cast("double")), F.when(both, x.cast("double"))
    spread = F.stddev_pop(y) * F.stddev_pop(x)
    return F.try_divide(F.covar_pop(y, x), spread)


def correlations(
    df: DataFrame, keys: Sequence[str], pairs: Mapping[str, tuple[Column, Column]],
    label: str = "pair", out: str = "correlation",
) -> DataFrame:
    """Correlation of several (y, x) pairs per group, one row per group and pair.

    The pairs become rows inside the scan stage, so that one small aggregate
    serves them all; with an aggregate per pair the generated code grows past
    what the JIT compiler takes.
    """
    rows = [
        F.struct(F.lit(n).alias(label), y.cast("double").alias("_y"), x.cast("double").alias("_x"))
        for n, (y, x) in pairs.items()
    ]
    long = df.select(*keys, F.inline(F.array(*rows)))
    return long.groupBy(*keys, label).agg(correlation(F.col("_y"), F.col("_x")).alias(out))


def dispersion_index(x: Column) -> Column:
    """Sample variance over the mean."""
    return F.try_divide(F.var_samp(x), F.avg(x))


def variation(x: Column) -> Column:
    """Coefficient of variation: sample standard deviation over the mean."""
    return F.try_divide(F.stddev_samp(x), F.avg(x))


def skewness(df: DataFrame, column: str) -> DataFrame:
    """Mean, median, sample deviation and 3 * (mean - median) / deviation of a column."""
    moments = df.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"))
    median = percentiles(df, [], column, {"median": 0.5}).scalar()
    return moments.withColumn("median", median).withColumn(
        "skew", F.try_divide(F.lit(3.0) * (F.col("mean") - F.col("median")), F.col("sd"))
    )


def mode_value(df: DataFrame, keys: Sequence[str], column: str, out: str = "mode") -> DataFrame:
    """Most frequent value per group, the smallest on ties, counted before the shuffle."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, column)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    best = F.min(F.struct((-F.col("_n")).alias("_order"), F.col(column).alias("_value")))
    return counts.groupBy(*keys).agg(best["_value"].alias(out))


def group_arrays(
    df: DataFrame, keys: Sequence[str], column: str, out: str, part: str = "part",
    part_size: int = 1_000_000, max_group_rows: int | None = None,
) -> DataFrame:
    """All values of each group as sorted arrays of at most ``part_size`` elements.

    A group of ordinary size is one row with part 0; a huge one continues in
    parts 1, 2, ..., so no row outgrows a task and nothing is cut off.
    ``column`` must be unique within a group; NULLs are left out.
    """
    rows = df.filter(F.col(column).isNotNull()).select(*keys, column)
    placed = along(
        rows, keys, [column], running={"_no": ("count", F.lit(1))}, max_group_rows=max_group_rows
    )
    placed = placed.withColumn(part, whole_quotient(F.col("_no") - 1, F.lit(part_size)))
    return placed.groupBy(*keys, part).agg(F.array_sort(F.collect_list(column)).alias(out))


def of_qualified(
    df: DataFrame, keys: Sequence[str], test: Column, aggregates: Mapping[str, Column]
) -> DataFrame:
    """Aggregates over the rows of those groups that pass an aggregate test."""
    groups = df.groupBy(*keys).agg(test.alias("_passes")).filter("_passes").select(*keys)
    kept = df.join(groups, list(keys), "left_semi")
    return kept.agg(*[column.alias(name) for name, column in aggregates.items()])


def entity_summary(
    entities: DataFrame, keys: Sequence[str],
    sources: Sequence[tuple[DataFrame, Mapping[str, Column]]],
    zero_when_missing: Sequence[str] = (),
) -> DataFrame:
    """One row per entity with aggregates of several sources.

    Each source is aggregated once by key and then joined, so no source
    multiplies the rows of another.
    """
    out = entities
    for source, aggregates in sources:
        summary = source.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
        out = out.join(summary, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_when_missing})


def filtered_percent(df: DataFrame, condition: Column, counted: Column, out: str) -> DataFrame:
    """Percentage of the counted rows that satisfy a condition; 0 when none are counted."""
    hits = percent(count_where(condition & counted), count_where(counted))
    return df.agg(F.coalesce(hits, F.lit(0.0)).alias(out))
