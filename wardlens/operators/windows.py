"""Time-series windows per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlens.operators.keys import join_back
from wardlens.operators.sequences import along
from wardlens.operators.ranking import top_rows


def neighbours(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
    outputs: Mapping[str, tuple[str, int]], max_group_rows: int | None = None,
) -> DataFrame:
    """Values n rows before (n > 0) or after (n < 0) along each entity."""
    return along(df, keys, order, shifts=outputs, max_group_rows=max_group_rows)


def difference(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], column: str,
    previous: str, out: str, max_group_rows: int | None = None,
) -> DataFrame:
    """Change since the previous reading; NULL for the first."""
    rows = along(df, keys, order, shifts={previous: (column, 1)}, max_group_rows=max_group_rows)
    return rows.withColumn(out, F.col(column) - F.col(previous))


def percent_jumps(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], column: str,
    threshold: float, previous: str, out: str, max_group_rows: int | None = None,
) -> DataFrame:
    """Readings more than ``threshold`` percent above the previous one.

    A missing previous reading, or one of 0, gives no percentage.
    """
    rows = difference(df, keys, order, column, previous, "_change", max_group_rows)
    change = F.try_divide(F.col("_change") * 100.0, F.col(previous))
    return rows.withColumn(out, change).filter(F.col(out) > threshold).drop("_change")


def daily_mean(
    df: DataFrame, keys: Sequence[str], time: str, measures: Mapping[str, str], day: str = "day"
) -> DataFrame:
    """Mean of each measure per entity and calendar day, averaged before the shuffle."""
    return df.groupBy(*keys, F.to_date(time).alias(day)).agg(
        *[F.avg(column).alias(out) for out, column in measures.items()]
    )


def falling_days(
    daily: DataFrame, keys: Sequence[str], day: str, measures: Sequence[str], days: int = 3
) -> DataFrame:
    """Days that end ``days`` adjacent calendar days with every measure falling.

    ``daily`` holds one row per entity and day, so an entity has no more rows
    than the calendar has days and one window task takes them.
    """
    window = Window.partitionBy(*keys).orderBy(day)
    rows, keep = daily, F.lit(True)
    for back in range(1, days):
        rows = rows.withColumns(
            {f"{m}_prev{back}": F.lag(m, back).over(window) for m in measures}
        ).withColumn(f"_day{back}", F.lag(day, back).over(window))
        keep = keep & (F.col(f"_day{back}") == F.date_sub(day, back))
        for m in measures:
            newer = m if back == 1 else f"{m}_prev{back - 1}"
            keep = keep & (F.col(newer) < F.col(f"{m}_prev{back}"))
    return rows.filter(keep).drop(*[f"_day{back}" for back in range(1, days)])


def equal_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str,
    longer_than: int, time: str, max_group_rows: int | None = None,
) -> DataFrame:
    """Runs of consecutive readings with one value, more than ``longer_than`` long.

    A reading starts a run when its value differs from the one before; the
    running count of starts names the run.  Missing values are left out first.
    """
    starts = F.when(F.col("_previous").eqNullSafe(F.col(value)), F.lit(0)).otherwise(F.lit(1))
    rows = along(
        df.filter(F.col(value).isNotNull()),
        keys,
        order,
        shifts={"_previous": (value, 1)},
        derive=lambda d: d.withColumn("_starts", starts),
        running={"run_no": ("sum", "_starts")},
        max_group_rows=max_group_rows,
    )
    return (
        rows.groupBy(*keys, "run_no", value)
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.min(time).alias("first_time"),
            F.max(time).alias("last_time"),
        )
        .filter(F.col("readings") > longer_than)
    )


def equal_day_runs(
    df: DataFrame, keys: Sequence[str], time: str, value: str, longer_than: int
) -> DataFrame:
    """The same value seen on more than ``longer_than`` adjacent calendar days."""
    days = df.filter(F.col(value).isNotNull()).select(
        *keys, value, F.to_date(time).alias("_day")
    ).distinct()
    place = F.row_number().over(Window.partitionBy(*keys, value).orderBy("_day"))
    return (
        days.withColumn("_island", F.date_sub("_day", place))
        .groupBy(*keys, value, "_island")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.min("_day").alias("first_day"),
            F.max("_day").alias("last_day"),
        )
        .filter(F.col("days") > longer_than)
        .drop("_island")
    )


def running_mean(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], column: str, out: str,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Mean of all readings up to the current one."""
    rows = along(
        df, keys, order,
        running={"_sum": ("sum", column), "_count": ("count", column)},
        max_group_rows=max_group_rows,
    )
    return rows.withColumn(out, F.try_divide(F.col("_sum"), F.col("_count"))).drop("_sum", "_count")


def running_max(
    df: DataFrame, keys: Sequence[str], order: str, column: str, out: str,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Largest value up to the current order value, rows of equal order included.

    Equal order values are reduced to one row before the window, so any number
    of them may tie.
    """
    peers = df.groupBy(*keys, order).agg(F.max(column).alias("_peak"))
    best = along(
        peers, keys, [order], running={out: ("max", "_peak")}, max_group_rows=max_group_rows
    )
    return join_back(df, best.drop("_peak"), [*keys, order], "inner")


def partition_count(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Size of each row's group, kept on the row."""
    return join_back(df, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)), keys, "inner")


def state_transitions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], state: str,
    before: str, now: str, carry: Mapping[str, tuple[str, int]] | None = None,
    max_group_rows: int | None = None,
) -> DataFrame:
    """Rows in state ``now`` whose entity was in state ``before`` one row earlier."""
    shifts = {"previous_state": (state, 1), **(carry or {})}
    rows = along(df, keys, order, shifts=shifts, max_group_rows=max_group_rows)
    return rows.filter((F.col("previous_state") == before) & (F.col(state) == now))


def period_counts(df: DataFrame, period: Column, name: str, out: str = "n") -> DataFrame:
    """Row count per calendar period."""
    return df.groupBy(period.alias(name)).agg(F.count(F.lit(1)).alias(out))


def over_periods(counts: DataFrame, period: str, **columns: Column) -> DataFrame:
    """Window expressions along one row per calendar period.

    The input is already grouped by a calendar unit, so its size is bounded by
    the calendar and not by the data.  Each expression is a window function
    still to be applied ``.over(Window.orderBy(period))``.
    """
    window = Window.orderBy(period)
    return counts.withColumns({name: column.over(window) for name, column in columns.items()})


def moving_mean(counts: DataFrame, period: str, column: str, rows: int, out: str) -> DataFrame:
    """Mean over the current and the ``rows - 1`` periods before it."""
    window = Window.orderBy(period).rowsBetween(-(rows - 1), Window.currentRow)
    return counts.withColumn(out, F.avg(column).over(window))


def first_steps(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], step: str, depth: int,
    out: str = "path",
) -> DataFrame:
    """The chain of each entity's first ``depth`` steps as ``a>b>c``.

    This is what following every row to its successor gives, level by level;
    only ``depth`` rows per entity leave a map task.
    """
    rows = top_rows(df, keys, order, depth, "_level")
    chain = F.array_sort(F.collect_list(F.struct("_level", F.col(step).alias("_step"))))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("steps"),
        F.array_join(F.transform(chain, lambda s: s["_step"]), ">").alias(out),
    )
