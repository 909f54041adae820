"""Followers with their columns, nodes reached over several hops, prefixes and days given as tables."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from wardlens.operators import joins, reports

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2024, 1, 1)


def visits(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "busy" if i < n // 3 else rng.choice(["a", "b", "c", None])
        at = None if rng.random() < 0.05 else START + DAY * rng.randint(0, 120)
        rows.append((key, i, at, rng.choice("xyz")))
    return rows


@pytest.mark.parametrize("limit", [25, 10**6])
@pytest.mark.parametrize("same_time", [False, True])
def test_first_followers_equal_brute_force(spark, limit, same_time):
    left, right = visits(150, 1), visits(200, 2)
    schema = "key string, id long, at timestamp, kind string"
    got = joins.first_followers(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["key"], "id", "at", "id", "at", 9, 4,
        {"other": "id", "other_kind": "kind", "seen": "at"}, include_same_time=same_time, max_group_rows=limit,
    )
    assert got.columns == ["key", "id", "at", "kind", "follower", "other", "other_kind", "seen"]
    want = []
    for key, i, at, kind in left:
        after = sorted(
            (r[2], r[1], r[3]) for r in right
            if key is not None and r[0] == key and at and r[2] and at <= r[2] <= at + 9 * DAY and (same_time or r[2] > at)
        )
        want += [(key, i, at, kind, n + 1, other, k, t) for n, (t, other, k) in enumerate(after[:4])]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_within_days_keeps_rows_without_time_or_key(spark):
    left = spark.createDataFrame([("a", 1, START, "x"), ("a", 2, None, "y"), (None, 3, START, "z")],
                                 "key string, id long, at timestamp, kind string")
    right = spark.createDataFrame([("a", 9, START + DAY), (None, 8, START + DAY)], "key string, id long, at timestamp")
    got = joins.within_days(left, right, ["key"], "id", "at", "id", "at", 3)
    assert got.columns == ["key", "id", "at", "kind", "followers", "next_time"]
    assert {r.id: (r.kind, r.followers, r.next_time) for r in got.collect()} == {
        1: ("x", 1, START + DAY), 2: ("y", 0, None), 3: ("z", 0, None)
    }


def test_reached_ends_on_cycles_and_counts_hops(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)]
    edges += [(k, k + 1) for k in range(100, 140)] + [(140, 100), (0, 0), (None, 5), (5, None)] + [(7, 200)] * 50
    seeds = [(0,), (100,), (7,), (7,), (None,), (999,)]
    table = spark.createDataFrame(edges, "a long, b long")
    start = spark.createDataFrame(seeds, "s long")
    want, front, hops = {}, {0, 100, 7, 999}, 0
    while front:
        want |= dict.fromkeys(front, hops)
        front = {b for a, b in edges if a in front and b is not None} - set(want)
        hops += 1
    got = joins.reached(table, start, "a", "b").collect()
    assert {r.node: r.hops for r in got} == want and len(got) == len(want)
    two = joins.reached(table, start, "a", "b", most_hops=2).collect()
    assert {r.node: r.hops for r in two} == {n: h for n, h in want.items() if h <= 2}
    assert joins.reached(table, start.limit(0), "a", "b").collect() == []


def test_ten_thousand_prefixes_by_one_join(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcé") for _ in range(n))
    rows = [(word(rng.randint(0, 9)), rng.randint(1, 200)) for _ in range(2000)] + [(None, 1), ("abc", None)]
    asked = [(word(rng.randint(0, 7)),) for _ in range(10_000)] + [(None,)]
    df = spark.createDataFrame(rows, "text string, value long")
    got = reports.counts_by_prefix(df, "text", "value", spark.createDataFrame(asked, "prefix string"))
    want = {p: len({v for t, v in rows if t is not None and v is not None and t.startswith(p)}) for (p,) in set(asked) if p is not None}
    assert {r.prefix: r.n for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and "startswith" not in plan.lower()
    assert reports.counts_by_prefix(df, "text", "value", spark.createDataFrame([], "prefix string")).collect() == []


def test_a_thousand_days_keep_the_plan_small_and_reach_the_scan(spark, tmp_path):
    rows = spark.range(40_000).select(
        (F.lit(datetime.datetime(2000, 1, 1)) + F.make_dt_interval(F.col("id").cast("int"))).alias("ts"),
        (F.col("id") % 17).cast("double").alias("value"),
    )
    rows.repartitionByRange(20, "ts").write.parquet(str(tmp_path / "r"))
    readings = spark.read.parquet(str(tmp_path / "r"))
    days = spark.range(1000).select(F.date_add(F.lit(datetime.date(2020, 3, 1)), F.col("id").cast("int") * 2).alias("day"))
    got = reports.mean_of_days(readings, "ts", "value", days)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 15_000 and "GreaterThanOrEqual(ts,2020-03-01" in plan.replace(" ", "").replace("T00:00:00", "")
    found = {r.day: r.mean for r in got.collect()}
    first = datetime.date(2000, 1, 1)
    assert len(found) == 1000
    assert all(m == ((d - first).days % 17 if (d - first).days < 40_000 else None) for d, m in found.items())


def test_days_without_any(spark):
    readings = spark.createDataFrame([(START, 1.0)], "ts timestamp, value double")
    none = spark.createDataFrame([(None,)], "day date")
    assert reports.mean_of_days(readings, "ts", "value", none).collect() == []
