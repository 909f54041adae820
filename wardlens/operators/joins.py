"""Joins with more to them than an equality of keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardlens.operators.keys import same_keys
from wardlens.operators.sequences import along
from wardlens.sources.staging import stage


def left_or(
    left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict[str, object]
) -> DataFrame:
    """Left outer join with values standing in for what is missing."""
    joined = left.join(right, list(keys), "left")
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def join_on_expression(
    left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "inner"
) -> DataFrame:
    """Equi-join on computed keys; each is computed once per row before the shuffle."""
    left, right = left.withColumn("_lk", left_key), right.withColumn("_rk", right_key)
    return left.join(right, F.col("_lk") == F.col("_rk"), how).drop("_lk", "_rk")


def within_days(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    left_time: str,
    right_id: str,
    right_time: str,
    days: int,
    include_same_time: bool = False,
    max_group_rows: int | None = None,
) -> DataFrame:
    """For each left row: how many right rows of its key follow within ``days``, and the first.

    Adds ``followers`` and ``next_time``.  Instead of forming pairs, whose
    number grows with the square of a busy key, both sides are merged into one
    ordered sequence that carries the left rows along.  ``left_id`` identifies a left row of a key.  Every left row puts one mark at its own time and one at
    the end of its range; the number of right rows between the marks is the
    difference of two running counts, and the first follower is the right row
    with the next number.  The work grows with the rows alone.
    """
    marks, points = _marked(
        left, right, keys, left_id, left_time, right_id, right_time, days, include_same_time, {}, max_group_rows
    )
    first = points.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col("_seen").alias("_no"), F.col("_time").alias("next_time"))
    wanted = F.when(F.col("followers") > 0, F.col("_before") + 1)
    found = marks.withColumn("_next", wanted).join(
        first, same_keys(keys, "_p_") & (F.col("_next") == F.col("_no")), "left"
    )
    return found.select("_row.*", "followers", "next_time")


def first_followers(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    left_time: str,
    right_id: str,
    right_time: str,
    days: int,
    most: int,
    take: Mapping[str, str],
    rank: str = "follower",
    include_same_time: bool = False,
    max_group_rows: int | None = None,
) -> DataFrame:
    """For each left row the first ``most`` right rows of its key that follow within ``days``.

    ``take`` maps outputs to columns of the right rows; ``rank`` counts them from 1, by time and then id.
    Left rows without followers give no row.  The right rows of a key are numbered along time, so a left
    row asks for its followers by key and number: ``most`` rows each at the most, however busy the key.
    """
    marks, points = _marked(
        left, right, keys, left_id, left_time, right_id, right_time, days, include_same_time, take, max_group_rows
    )
    last = F.least(F.col("followers"), F.lit(most).cast("bigint"))
    asked = marks.filter("followers > 0").select(
        "_row", *[F.col(k).alias(f"_m_{k}") for k in keys], "_before",
        F.explode(F.sequence(F.lit(1).cast("bigint"), last)).alias("_rank"),
    )
    same = (F.col("_no") == F.col("_before") + F.col("_rank")) & same_keys(keys, "_m_")
    numbered_points = points.select(*keys, F.col("_seen").alias("_no"), "_take")
    return asked.join(numbered_points, same).select(
        "_row.*", F.col("_rank").alias(rank), *[F.col(f"_take.{name}").alias(name) for name in take]
    )


def _marked(
    left, right, keys, left_id, left_time, right_id, right_time, days, include_same_time, take, max_group_rows
) -> tuple[DataFrame, DataFrame]:
    """Left rows (``_row``) with the right rows of their key before them and following them, and the right
    rows numbered along time with what is to be taken from them."""
    # Order at one instant: start marks count what lies before them, so a right
    # row at the start time falls after the mark only when it is included.
    start_kind, end_kind = (0 if include_same_time else 2), 2
    span = F.expr(f"INTERVAL {int(days)} DAYS")
    row = F.struct(*[F.col(c) for c in left.columns])
    taken = F.struct(*[F.col(c).alias(n) for n, c in take.items()]) if take else F.lit(0)
    row_type = left.select(row.alias("_")).schema["_"].dataType
    take_type = right.select(taken.alias("_")).schema["_"].dataType
    time = F.col(left_time)
    # The row travels with its start mark alone; a row without a time has no range to follow in.
    marks = F.array(
        F.struct(time.alias("_time"), F.lit(start_kind).alias("_kind"), F.lit("start").alias("_mark"), row.alias("_row")),
        F.struct((time + span).alias("_time"), F.lit(end_kind).alias("_kind"), F.lit("end").alias("_mark"),
                 F.lit(None).cast(row_type).alias("_row")),
    )
    marked = left.select(*keys, F.col(left_id).alias("_id"), F.inline(marks)).select(
        *keys, "_id", "_time", "_kind", "_mark", "_row", F.lit(0).alias("_one"), F.lit(None).cast(take_type).alias("_take")
    )
    points = right.filter(F.col(right_time).isNotNull()).select(
        *keys, F.col(right_id).cast(left.schema[left_id].dataType).alias("_id"), F.col(right_time).alias("_time"),
        F.lit(1).alias("_kind"), F.lit("point").alias("_mark"), F.lit(None).cast(row_type).alias("_row"),
        F.lit(1).alias("_one"), taken.alias("_take"),
    )
    order = ["_time", "_kind", "_mark", "_id"]
    seen = along(
        points.unionByName(marked), keys, order, running={"_seen": ("sum", "_one")}, max_group_rows=max_group_rows
    )
    start = F.col("_mark") == "start"
    ends = (
        seen.filter(F.col("_mark") != "point")
        .groupBy(*keys, "_id")
        .agg(
            F.max(F.when(start, F.col("_seen"))).alias("_before"),
            F.max(F.when(F.col("_mark") == "end", F.col("_seen"))).alias("_through"),
            F.first("_row", ignorenulls=True).alias("_row"),
        )
    )
    known = F.col(f"_row.{left_time}").isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    followers = F.when(known, F.col("_through") - F.col("_before")).otherwise(F.lit(0)).cast("bigint")
    return ends.withColumn("followers", followers), seen.filter(F.col("_mark") == "point")


def reached(
    edges: DataFrame, seeds: DataFrame, source: str, target: str, node: str = "node", hops: str = "hops",
    most_hops: int | None = None,
) -> DataFrame:
    """All nodes that edges lead to from the seeds, with the least number of edges on the way (seeds: 0).

    Each round joins only the nodes that the last one added, drops those known already, and is
    written to the shared folder, so cycles end and the plan stays short.  The rounds end when nothing is
    added or after ``most_hops``.  NULL nodes lead nowhere; repeated edges and seeds don't matter.  A
    node that many edges lead to is reduced to one before it is joined again.
    """
    links = edges.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    links = stage(links.filter("_from IS NOT NULL AND _to IS NOT NULL").distinct(), "edges")
    first = seeds.select(F.col(seeds.columns[0]).alias(node)).filter(F.col(node).isNotNull()).distinct()
    front = stage(first.withColumn(hops, F.lit(0)), "reached")
    known = front
    while most_hops is None or most_hops > 0:
        most_hops = None if most_hops is None else most_hops - 1
        onward = front.join(links, F.col(node) == F.col("_from")).groupBy(F.col("_to").alias(node)).agg(
            (F.min(hops) + 1).alias(hops)
        )
        front = stage(onward.join(known.select(node), node, "left_anti").select(node, hops), "reached")
        if front.isEmpty():
            break
        known = known.union(front)
    return known


def rows_after_first(
    df: DataFrame, first_of: DataFrame, keys: Sequence[str], time: str, first_time: str
) -> DataFrame:
    """Rows later than their entity's first time in ``first_of``, with that time."""
    first = first_of.groupBy(*keys).agg(F.min(time).alias(first_time))
    return df.join(first, list(keys)).filter(F.col(time) > F.col(first_time))


def linked_rows(df: DataFrame, seed: Column, keys: Sequence[str]) -> DataFrame:
    """All rows of the entities that have at least one row satisfying ``seed``."""
    return df.join(df.filter(seed).select(*keys).distinct(), list(keys), "left_semi")
