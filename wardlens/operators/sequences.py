"""Ordered work along each group that stays balanced when one group is huge.

A plain window sends a whole group to one task.  That is right for groups of
ordinary size, so it is what ``along`` does for them.  Groups with more rows
than ``max_group_rows`` are found first by a pre-aggregated count and take
another way with the same result: their rows are range-sorted over the whole
cluster, numbered, and cut into chunks of equal size.  Neighbour values near a
cut come from copies of the few rows across it; running values add the totals
of the chunks before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType

from wardlens.functions.exact_sums import (
    ALL_DOUBLES, addends, range_aggregates, range_totals, total, words_for, words_from,
)
from wardlens.operators.keys import join_back, same_keys
from wardlens.sources.staging import stage

DEFAULT_MAX_GROUP_ROWS = 4_000_000

_COMBINE = {
    "sum": lambda before, here: F.when(before.isNull(), here).otherwise(
        F.coalesce(before + here, before)
    ),
    "count": lambda before, here: F.coalesce(before, F.lit(0)) + here,
    "min": F.least,
    "max": F.greatest,
}
_AGGREGATE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_OF_TOTALS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def group_limit(df: DataFrame, given: int | None) -> int:
    """Rows a single window task may be given (``spark.wardlens.maxGroupRows``)."""
    if given is not None:
        return given
    conf = df.sparkSession.conf.get("spark.wardlens.maxGroupRows", None)
    return int(conf) if conf else DEFAULT_MAX_GROUP_ROWS


def placed_in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """Range-sort all rows over the cluster and fix each row's range and place in it.

    Adds ``_seq_range`` and ``_seq_within`` (from 0) and stages the result, so
    ranges stay what they are whatever is recomputed later.  AQE joins small
    neighbouring ranges, which keeps their order.
    """
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_seq_place", place)
    )
    within = F.col("_seq_place").bitwiseAND(F.lit((1 << 33) - 1))
    return stage(
        placed.withColumn("_seq_range", F.shiftright("_seq_place", 33))
        .withColumn("_seq_within", within)
        .drop("_seq_place"),
        "placed",
    )


def add_range_starts(placed: DataFrame, **totals: Column) -> DataFrame:
    """Add to each row what the aggregates sum to over all earlier ranges.

    One row per range is summed up and broadcast; there are no more ranges than
    the session has shuffle partitions.
    """
    sizes = placed.groupBy("_seq_range").agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.orderBy("_seq_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_seq_range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in totals]
    )
    return placed.join(F.broadcast(starts), "_seq_range")


def numbered(df: DataFrame, *order: Column | str, out: str = "row_no") -> DataFrame:
    """Number all rows 1..N by a total order without gathering them in one task.

    ``order`` must end in a unique key.
    """
    placed = placed_in_ranges(df, *order)
    rows = add_range_starts(placed, _seq_start=F.count(F.lit(1)))
    return rows.withColumn(out, F.col("_seq_start") + F.col("_seq_within") + 1).select(
        *df.columns, out
    )


def oversized_groups(sizes: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """The groups with more than ``limit`` rows as a staged table, or None.

    ``sizes`` has the keys and ``_n``, rows per group.  The driver only asks whether there are any.
    """
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= limit:
        return None
    return stage(sizes.filter(F.col("_n") > limit).select(*keys), "oversized")


def along(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    shifts: Mapping[str, tuple[str, int]] | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    running: Mapping[str, tuple[str, Column | str]] | None = None,
    max_group_rows: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Neighbour and running values along ``order`` within each group.

    ``shifts`` maps an output to (column, n): the value n rows before (n > 0)
    or after (n < 0).  ``derive`` may then add row-wise columns.  ``running``
    maps an output to (sum | count | min | max, column) over the rows from the
    group's first to the current one.  ``order`` must be total within a group.
    Sums of doubles are added up as whole numbers (see ``functions.exact_sums``), so both ways give
    the same bits at any magnitude; a NaN, or infinities of both signs, make the sum NaN from there on.
    Callers that know the rows per group pass them as ``sizes`` (keys and ``_n``).
    Without keys the rows are always cut into chunks.
    """
    shifts, running = dict(shifts or {}), dict(running or {})
    derive = derive or (lambda d: d)
    limit = group_limit(df, max_group_rows)
    doubles, measured = _double_sums(df, shifts, derive, running)
    hot, words = None, dict.fromkeys(doubles, ALL_DOUBLES)
    if keys and sizes is None:
        # One job tells the size of the largest group and the range of the values to add up.
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *range_aggregates(measured))
        most = sizes.agg(F.max("_n").alias("_n"), *range_totals(measured)).first()
        words |= words_from(most, measured)
        if (most["_n"] or 0) > limit:
            hot = stage(sizes.filter(F.col("_n") > limit).select(*keys), "oversized")
    else:
        words |= words_for(df, measured) if measured else {}
        hot = oversized_groups(sizes, keys, limit) if keys else None
    running, finish = _exact_sums(doubles, words, running)
    return finish(_along(df, keys, order, shifts, derive, running, limit, hot))


def _along(df, keys, order, shifts, derive, running, limit, hot) -> DataFrame:
    if not keys:
        return _by_chunks(df, keys, order, shifts, derive, running, limit)
    if hot is None:
        return _by_window(df, keys, order, shifts, derive, running)
    hot = hot.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    usual = df.join(hot, same_keys(keys), "left_anti")
    large = df.join(hot, same_keys(keys), "left_semi")
    return _by_window(usual, keys, order, shifts, derive, running).unionByName(
        _by_chunks(large, keys, order, shifts, derive, running, limit)
    )


def _double_sums(df, shifts, derive, running) -> tuple[dict[str, Column], dict[str, Column]]:
    """The running sums of doubles, and those of them whose values the input has already."""
    sums = {n: F.col(c) if isinstance(c, str) else c for n, (fn, c) in running.items() if fn == "sum"}
    if not sums:
        return {}, {}
    shifted = {name: F.lit(None).cast(df.schema[col].dataType) for name, (col, _) in shifts.items()}
    shape = derive(df.withColumns(shifted))
    kinds = shape.select(*[c.alias(n) for n, c in sums.items()]).schema
    doubles = {n: c for n, c in sums.items() if isinstance(kinds[n].dataType, (DoubleType, FloatType))}
    return doubles, doubles if shape.columns == df.columns else {}


def _exact_sums(doubles, words, running) -> tuple[dict, Callable[[DataFrame], DataFrame]]:
    """The running aggregates with sums of doubles taken apart into words, and what puts them together."""
    if not doubles:
        return running, lambda rows: rows
    out = {name: pair for name, pair in running.items() if name not in doubles}
    parts = {}
    for name, column in doubles.items():
        added = addends(column, words[name])
        parts[name] = [f"_word_{name}_{k}" for k in range(len(added))]
        out |= {part: ("sum", value) for part, value in zip(parts[name], added)}

    def finish(rows: DataFrame) -> DataFrame:
        kept = [F.col(c) for c in rows.columns if not any(c in p for p in parts.values())]
        sums = [total([F.col(p) for p in parts[name]], words[name]).alias(name) for name in doubles]
        return rows.select(*kept, *sums)

    return out, finish


def _by_window(df, keys, order, shifts, derive, running) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = derive(
        df.withColumns({name: _shift(col, n).over(window) for name, (col, n) in shifts.items()})
    )
    return out.withColumns(
        {name: _AGGREGATE[fn](col).over(so_far) for name, (fn, col) in running.items()}
    )


def _shift(column, n: int) -> Column:
    return F.lag(column, n) if n > 0 else F.lead(column, -n)


def _by_chunks(df, keys, order, shifts, derive, running, size: int) -> DataFrame:
    rows = numbered(df, *keys, *order, out="_seq_no").withColumn("_seq_chunk", _chunk_of(F.col("_seq_no"), size))
    if shifts:
        rows = _shift_over_cuts(rows, keys, shifts, size)
    rows = derive(rows)
    if running:
        rows = _run_over_cuts(rows, keys, running)
    return rows.drop("_seq_no", "_seq_chunk")


def _chunk_of(number: Column, size: int) -> Column:
    return F.call_function("div", number - 1, F.lit(size).cast("bigint"))


def _shift_over_cuts(rows, keys, shifts, size) -> DataFrame:
    back = max([n for _, n in shifts.values() if n > 0], default=0)
    ahead = max([-n for _, n in shifts.values() if n < 0], default=0)
    if max(back, ahead) >= size:
        raise ValueError("a shift must be shorter than a chunk")
    number = F.col("_seq_no")
    needed_by = F.array_distinct(
        F.array(
            F.col("_seq_chunk"),
            _chunk_of(number + back, size),
            _chunk_of(F.greatest(number - ahead, F.lit(1).cast("bigint")), size),
        )
    )
    window = Window.partitionBy("_seq_in").orderBy("_seq_no")

    def value(column: str, n: int) -> Column:
        same_group = F.lit(True)
        for key in keys:
            same_group = same_group & _shift(key, n).over(window).eqNullSafe(F.col(key))
        return F.when(same_group, _shift(column, n).over(window))

    return (
        rows.withColumn("_seq_in", F.explode(needed_by))
        .withColumns({name: value(col, n) for name, (col, n) in shifts.items()})
        .filter(F.col("_seq_in") == F.col("_seq_chunk"))
        .drop("_seq_in")
    )


def _run_over_cuts(rows, keys, running) -> DataFrame:
    group = [*keys, "_seq_chunk"]
    totals = rows.groupBy(*group).agg(
        *[_AGGREGATE[fn](col).alias(f"_all_{name}") for name, (fn, col) in running.items()]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_seq_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = totals.select(
        *group,
        *[
            _OF_TOTALS[fn](f"_all_{name}").over(earlier).alias(f"_before_{name}")
            for name, (fn, _) in running.items()
        ],
    )
    here = (
        Window.partitionBy(*group)
        .orderBy("_seq_no")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = rows.withColumns(
        {f"_here_{name}": _AGGREGATE[fn](col).over(here) for name, (fn, col) in running.items()}
    )
    out = join_back(out, before, group)
    out = out.withColumns(
        {
            name: _COMBINE[fn](F.col(f"_before_{name}"), F.col(f"_here_{name}"))
            for name, (fn, _) in running.items()
        }
    )
    return out.drop(*[f"_{part}_{name}" for name in running for part in ("before", "here")])
