"""The way oversized groups take must give what a plain window gives."""

import random

import pytest
from pyspark.sql import Window, functions as F

from wardlens.operators import aggregates, joins, percentiles, reports, windows
from wardlens.operators.sequences import along, numbered, oversized_groups

ROWS_OF_BUSY, LIMIT = 700, 40


@pytest.fixture(scope="module")
def readings(spark):
    """One key with most rows, a NULL key, small keys, equal times, missing values."""
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        key = "busy" if i < ROWS_OF_BUSY else rng.choice(["a", "b", "c", None, "d"])
        value = None if rng.random() < 0.1 else float(rng.randint(1, 4))
        rows.append((i, key, rng.randint(1, 300), value, rng.choice("xyz")))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "id long, key string, at int, value double, state string")
    return frame.cache()


def same(left, right):
    order = sorted(left.columns)
    a = sorted(map(repr, left.select(order).collect()))
    b = sorted(map(repr, right.select(order).collect()))
    assert a == b
    assert a


def test_finds_only_large_groups(readings):
    sizes = readings.groupBy("key").agg(F.count("*").alias("_n"))
    assert {r["key"] for r in oversized_groups(sizes, ["key"], 600).collect()} == {"busy"}
    assert oversized_groups(sizes, ["key"], 10_000) is None


@pytest.mark.parametrize("limit", [3, 50, 500, 10_000])
def test_running_means_of_doubles_do_not_depend_on_the_limit(spark, limit):
    """Doubles from 10^-6 to 10^6, and more oversized groups than any list of them would hold."""
    rng = random.Random(11)
    rows = [(i, i % 3 if i % 2 else 100 + i % 10_500, rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 6)) for i in range(60_000)]
    df = spark.createDataFrame(rows, "id long, key int, value double").cache()
    got = windows.running_mean(df, ["key"], ["id"], "value", "mean", max_group_rows=limit)
    want = windows.running_mean(df, ["key"], ["id"], "value", "mean", max_group_rows=10**6)
    assert got.exceptAll(want).isEmpty() and got.count() == len(rows)


def test_numbered_is_the_global_order(readings):
    got = numbered(readings, "at", F.col("id").desc(), out="n").select("id", "n")
    want = readings.select(
        "id", F.row_number().over(Window.orderBy("at", F.col("id").desc())).cast("bigint").alias("n")
    )
    same(got, want)


@pytest.mark.parametrize("limit", [LIMIT, 7, 300])
def test_shifts(readings, limit):
    shifts = {"p1": ("value", 1), "p3": ("state", 3), "n1": ("value", -1), "n2": ("state", -2)}
    w = Window.partitionBy("key").orderBy("at", "id")
    want = readings.withColumns(
        {
            "p1": F.lag("value", 1).over(w), "p3": F.lag("state", 3).over(w),
            "n1": F.lead("value", 1).over(w), "n2": F.lead("state", 2).over(w),
        }
    )
    same(along(readings, ["key"], ["at", "id"], shifts=shifts, max_group_rows=limit), want)


@pytest.mark.parametrize("limit", [LIMIT, 3, 300])
def test_running_values(readings, limit):
    running = {
        "s": ("sum", "value"), "c": ("count", "value"), "lo": ("min", "value"),
        "hi": ("max", "value"), "n": ("count", F.lit(1)),
    }
    w = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = readings.withColumns(
        {
            "s": F.sum("value").over(w), "c": F.count("value").over(w), "lo": F.min("value").over(w),
            "hi": F.max("value").over(w), "n": F.count(F.lit(1)).over(w),
        }
    )
    same(along(readings, ["key"], ["at", "id"], running=running, max_group_rows=limit), want)


def test_descending_order_and_no_keys(readings):
    order = [F.col("at").desc(), F.col("id").desc()]
    w = Window.orderBy(*order)
    want = readings.select("id", F.lag("value", 2).over(w).alias("p"))
    got = along(readings.select("id", "at", "value"), [], order, shifts={"p": ("value", 2)}, max_group_rows=50)
    same(got.select("id", "p"), want)


def test_a_shift_longer_than_a_chunk_is_refused(readings):
    with pytest.raises(ValueError):
        along(readings, ["key"], ["at", "id"], shifts={"p": ("value", 9)}, max_group_rows=5)


def test_equal_runs(readings):
    def runs(limit):
        return windows.equal_runs(readings, ["key"], ["at", "id"], "state", 1, "at", limit)

    same(runs(LIMIT), runs(10**6))
    lengths = windows.equal_runs(readings, ["key"], ["at", "id"], "state", 0, "at", LIMIT)
    assert lengths.agg(F.sum("readings")).first()[0] == readings.count()


def test_running_mean_and_max(readings):
    for op in (
        lambda limit: windows.running_mean(readings, ["key"], ["at", "id"], "value", "m", limit),
        lambda limit: windows.running_max(readings, ["key"], "at", "value", "m", limit),
        lambda limit: windows.percent_jumps(readings, ["key"], ["at", "id"], "value", 30, "p", "pct", limit),
        lambda limit: windows.state_transitions(
            readings, ["key"], ["at", "id"], "state", "x", "y", max_group_rows=limit
        ),
    ):
        same(op(LIMIT), op(10**6))


def test_running_max_includes_equal_times(readings):
    w = Window.partitionBy("key").orderBy("at")
    want = readings.withColumn("m", F.max("value").over(w))
    same(windows.running_max(readings, ["key"], "at", "value", "m", LIMIT), want)


@pytest.mark.parametrize("keys", [["key"], []])
def test_percentiles(readings, keys):
    quantiles = {"q25": 0.25, "median": 0.5, "p99": 0.99}
    want = readings.groupBy(*keys).agg(
        *[F.expr(f"percentile(value, {q})").alias(n) for n, q in quantiles.items()]
    )
    for limit in (2, 10**6):
        same(percentiles.percentiles(readings, keys, "value", quantiles, limit), want)


def test_median_by_rank_agrees_with_percentile(readings):
    by_count = percentiles.percentiles(readings, ["key"], "value", {"median": 0.5})
    for limit in (LIMIT, 10**6):
        same(percentiles.median_by_rank(readings, ["key"], "value", "id", "median", limit), by_count)


def test_group_arrays_keep_every_value(readings):
    parts = aggregates.group_arrays(readings, ["key"], "id", "ids", part_size=100, max_group_rows=LIMIT)
    rows = parts.collect()
    assert max(len(r["ids"]) for r in rows) <= 100
    got = sorted((repr(r["key"]), i) for r in rows for i in r["ids"])
    want = sorted((repr(r["key"]), r["id"]) for r in readings.collect())
    assert got == want
    busy = [r["ids"] for r in sorted(rows, key=lambda r: r["part"]) if r["key"] == "busy"]
    assert sum(busy, []) == sorted(sum(busy, []))


@pytest.mark.parametrize("include", [False, True])
def test_within_days_counts_what_pairs_would(spark, readings, include):
    visits = readings.filter(F.col("key").isNotNull()).select(
        "id", "key", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,at)").alias("at")
    )
    left, right = visits.filter("id % 3 = 0"), visits.filter("id % 2 = 0")
    r = right.select(F.col("key").alias("k"), F.col("at").alias("b"))
    lower = (F.col("b") >= F.col("at")) if include else (F.col("b") > F.col("at"))
    pairs = left.join(
        r, (F.col("k") == F.col("key")) & lower & (F.col("b") <= F.col("at") + F.expr("INTERVAL 30 DAYS")),
        "left",
    )
    want = pairs.groupBy("id").agg(F.count("b").alias("followers"), F.min("b").alias("next_time"))
    for limit in (LIMIT, 10**6):
        got = joins.within_days(
            left, right, ["key"], "id", "at", "id", "at", 30, include, limit
        ).select("id", "followers", "next_time")
        same(got, want)


def test_prefixes_meet_counts_not_rows(spark):
    """A prefix that all texts have is counted before the join, so its rows never meet in one task."""
    rows = [(f"ab{i % 3}", i % 50) for i in range(400)] + [("zz", None), (None, 1), ("ab", 7)]
    asked = [("a",), ("ab1",), ("ab1",), ("q",), (None,), ("",)]
    got = reports.counts_by_prefix(
        spark.createDataFrame(rows, "name string, id int"), "name", "id", spark.createDataFrame(asked, "prefix string")
    )
    want = {p: len({i for t, i in rows if t is not None and i is not None and t.startswith(p)}) for p in ("a", "ab1", "q", "")}
    assert {r.prefix: r.n for r in got.collect()} == want and got.count() == len(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
