"""Routines that answer for every entity at once; one entity is a filter on the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardlens.functions.text import csv_line, matching_prefixes
from wardlens.operators.aggregates import share_of_total
from wardlens.operators.windows import daily_mean
from wardlens.sources.inline import inline_rows


def distinct_by_prefix(
    df: DataFrame, column: str, prefixes: Sequence[str], id_column: str, out: str = "n",
    facts: DataFrame | None = None, key: str | None = None,
) -> DataFrame:
    """Distinct ids per prefix of a text column, 0 for a prefix nothing starts with.

    Where the ids stand in another table, ``facts`` names it and ``key`` the column both share:
    the prefixes are matched first, and only rows with a hit are joined.
    """
    found = F.explode(matching_prefixes(F.col(column), prefixes)).alias("prefix")
    if facts is None:
        hits = df.select(id_column, found)
    else:
        hits = facts.select(key, id_column).join(df.select(key, found), key).select(id_column, "prefix")
    counts = hits.groupBy("prefix").agg(F.count_distinct(id_column).alias(out))
    asked = inline_rows(df.sparkSession, [(p,) for p in prefixes], "prefix string")
    return asked.join(counts, "prefix", "left").withColumn(out, F.coalesce(out, F.lit(0)))


def group_percentage(df: DataFrame, column: str) -> DataFrame:
    """Percentage of all rows for every value of a column."""
    return share_of_total(df, [column])


def entity_csv(
    entities: DataFrame, others: Sequence[DataFrame], key: str, columns: Sequence[Column],
    out: str = "details", how: str = "left",
) -> DataFrame:
    """One comma-separated text per entity from columns of several tables."""
    joined = entities
    for other in others:
        joined = joined.join(other, key, how)
    return joined.select(key, csv_line(*columns).alias(out))


def mean_of_days(
    df: DataFrame, time: str, column: str, days: Sequence[str] | DataFrame, out: str = "mean"
) -> DataFrame:
    """Daily mean for each requested day, NULL for a day without readings.

    ``days`` is a list of dates or a table whose first column holds them.  Of any number of days only the
    first and the last enter the plan, as bounds of the raw time that reach the scan and skip row groups;
    the rest is a semi-join by day.  NULL and repeated days count once or not at all.
    """
    if not isinstance(days, DataFrame):
        days = inline_rows(df.sparkSession, [(d,) for d in days], "day string")
    asked = days.select(F.to_date(F.col(days.columns[0])).alias("day")).filter("day IS NOT NULL").distinct()
    first, last = asked.agg(F.min("day"), F.max("day")).first()
    kind = df.schema[time].dataType
    low, high = F.lit(first).cast("date").cast(kind), F.date_add(F.lit(last).cast("date"), 1).cast(kind)
    inside = df.filter((F.col(time) >= low) & (F.col(time) < high))
    wanted = asked.select(F.col("day").alias("_asked"))
    in_days = inside.join(wanted, F.to_date(time) == F.col("_asked"), "left_semi")
    return asked.join(daily_mean(in_days, [], time, {out: column}), "day", "left")


def counts_by_prefix(
    df: DataFrame, text: str, value: str, prefixes: DataFrame, prefix: str = "prefix", out: str = "n"
) -> DataFrame:
    """How many different values go with texts that begin with each prefix of a table, 0 if none.

    Texts are cut to each length that prefixes have (the driver sees the lengths alone) and meet them by
    an equi-join, so the work does not grow with the number of prefixes.  Different (text, value)
    pairs are found first, and values are counted before that join, so no prefix's rows meet in one
    task.  NULL prefixes are left out; the empty prefix fits every text.
    """
    asked = prefixes.select(F.col(prefix).alias(prefix)).filter(F.col(prefix).isNotNull()).distinct()
    lengths = sorted(r[0] for r in asked.select(F.char_length(prefix)).distinct().collect())
    pairs = df.select(F.col(text).alias("_text"), F.col(value).alias("_value")).filter("_value IS NOT NULL").distinct()
    heads = F.array(*[F.when(F.char_length("_text") >= n, F.left("_text", F.lit(n))) for n in lengths])
    cut = pairs.select("_value", F.explode(heads if lengths else F.array().cast("array<string>")).alias("_head"))
    found = cut.filter("_head IS NOT NULL").distinct()
    counted = found.groupBy("_head").agg(F.count("_value").alias("_n"))
    zero = F.lit(0).cast("bigint")
    return asked.join(counted, F.col(prefix) == F.col("_head"), "left").select(prefix, F.coalesce("_n", zero).alias(out))
