"""Tables turned on their side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def crosstab(
    df: DataFrame, rows: Sequence[str], column: str, names: Mapping[object, str]
) -> DataFrame:
    """Row counts with one column per listed value; NULL where no row falls.

    The value list is fixed by the caller, so no extra job looks for it.
    """
    wide = df.groupBy(*rows).pivot(column, list(names)).agg(F.count(F.lit(1)))
    for value, name in names.items():
        wide = wide.withColumnRenamed(str(value), name)
    return wide


def measures_by_category(
    df: DataFrame, measures: Mapping[str, Column], column: str, categories: Mapping[object, str],
    label: str = "measure",
) -> DataFrame:
    """Measures as rows, categories as columns, counted in one pass.

    Each cell is the number of rows of the category that satisfy the measure.
    The one aggregated row is then stacked into one row per measure.
    """
    cells = [
        F.sum(
            F.when(condition & (F.col(column) == F.lit(value)), F.lit(1)).otherwise(F.lit(0))
        ).alias(f"m{i}_c{j}")
        for i, condition in enumerate(measures.values())
        for j, value in enumerate(categories)
    ]
    rows = [
        F.struct(
            F.lit(name).alias(label),
            *[F.col(f"m{i}_c{j}").alias(out) for j, out in enumerate(categories.values())],
        )
        for i, name in enumerate(measures)
    ]
    return df.agg(*cells).select(F.inline(F.array(*rows)))


def unpivot_sum(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], out: str = "total",
    label: str | None = "kind",
) -> DataFrame:
    """Sum of several columns read as rows, per key and, with ``label``, per column.

    ``columns`` maps a column to its label.  Rows are unpivoted within the scan
    stage and summed before the shuffle.
    """
    long = df.select(*keys, *[F.col(c).cast("double").alias(n) for c, n in columns.items()])
    long = long.unpivot(list(keys), list(columns.values()), "_label", "_value")
    group = [*keys, F.col("_label").alias(label)] if label else list(keys)
    return long.filter(F.col("_value").isNotNull()).groupBy(*group).agg(F.sum("_value").alias(out))


def band_counts(df: DataFrame, band: Column, name: str = "band") -> DataFrame:
    """Histogram over an expression that names each row's band."""
    return df.groupBy(band.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def side_by_side(
    sources: Mapping[str, tuple[DataFrame, Column]], name: str
) -> DataFrame:
    """Counts of several event sources per common bucket, one column per source.

    Each source is counted by its own bucket expression first; the small counts
    are then put together, 0 standing for a bucket a source never hits.
    """
    parts = None
    for source, (df, bucket) in sources.items():
        counts = df.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("_n"))
        counts = counts.withColumn("_source", F.lit(source))
        parts = counts if parts is None else parts.unionByName(counts)
    cells = [
        F.sum(F.when(F.col("_source") == s, F.col("_n")).otherwise(F.lit(0))).alias(s)
        for s in sources
    ]
    return parts.groupBy(name).agg(*cells)
