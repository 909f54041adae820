"""Ranks against plain windows, and the plans that keep them balanced."""

import random
import re

import pytest
from pyspark.sql import Window, functions as F

from wardlens.operators import ranking
from wardlens.plans import catalog


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(3)
    rows = [
        (i, rng.choice([None, 1, 2, 2, 2, 3]), rng.choice(["x", "y"]), rng.choice("abc"))
        for i in range(400)
    ]
    return spark.createDataFrame(rows, "id int, score int, tag string, dept string").cache()


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("dense", [False, True])
def test_global_rank_agrees_with_a_window(people, dense):
    w = Window.orderBy(F.col("score").desc_nulls_last(), F.col("tag").asc_nulls_last())
    fn = F.dense_rank if dense else F.rank
    want = people.withColumn("rank", fn().over(w).cast("bigint"))
    assert rows(ranking.global_rank(people, ["score", "tag"], [True, False], dense=dense)) == rows(want)


@pytest.mark.parametrize("n, dense", [(1, False), (2, True), (150, False), (3, False)])
def test_top_values_keeps_every_tie(people, n, dense):
    fn = F.dense_rank if dense else F.rank
    w = Window.partitionBy("dept").orderBy(F.col("score").desc())
    want = (
        people.filter("score is not null").withColumn("rank", fn().over(w)).filter(F.col("rank") <= n)
    )
    assert rows(ranking.top_values(people, ["dept"], "score", n, dense=dense)) == rows(want)


@pytest.mark.parametrize("count, tiles", [(400, 4), (7, 4), (3, 4), (1, 4), (10, 3)])
def test_ntile_sizes(people, count, tiles):
    part = people.filter(F.col("id") < count)
    got = ranking.ntile(part, ["score", "id"], tiles, "tile")
    want = part.withColumn("tile", F.ntile(tiles).over(Window.orderBy("score", "id")))
    assert rows(got) == rows(want)
    sizes = [r["count"] for r in got.groupBy("tile").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_surrogate_key_is_one_to_n(people):
    numbers = [r["n"] for r in ranking.surrogate_key(people, ["tag", "id"], "n").select("n").collect()]
    assert sorted(numbers) == list(range(1, 401))


def test_surrogate_key_of_nothing(people):
    assert ranking.surrogate_key(people.filter("id < 0"), ["id"], "n").count() == 0


def test_rows_at_last_time(spark):
    data = [("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 5, 4), ("c", None, 5)]
    df = spark.createDataFrame(data + [("z", 9, 100 + i) for i in range(30)], "k string, t int, id int")
    got = ranking.rows_at_last_time(df, ["k"], "t", [F.col("id")]).collect()
    assert sorted(r["id"] for r in got if r["k"] in "ab") == [2, 3, 4]
    assert sorted(r["id"] for r in got if r["k"] == "z") == list(range(100, 130))
    ten = ranking.rows_at_last_time(df, ["k"], "t", [F.col("id")], 10).collect()
    assert sorted(r["id"] for r in ten if r["k"] == "z") == list(range(100, 110))


def test_most_and_least_frequent(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), ("d",)], "v string")
    assert [tuple(r) for r in ranking.most_frequent(df, [], "v").collect()] == [("a", 2)]
    assert {r["v"] for r in ranking.most_frequent(df, [], "v", ties=True).collect()} == {"a", "b"}
    assert {r["v"] for r in ranking.most_frequent(df, [], "v", ties=True, least=True).collect()} == {"c", "d"}
    assert [tuple(r) for r in ranking.most_frequent(df, [], "v", least=True).collect()] == [("c", 1)]


def test_nth_distinct(people):
    assert {r["score"] for r in ranking.nth_distinct(people, "score", 2).collect()} == {2}
    assert ranking.nth_distinct(people, "score", 9).count() == 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def window_over_single_partition(plan: str) -> list[str]:
    """Window nodes whose input is one partition, with their input."""
    lines, found = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and any("Window [" in above for above in lines[max(0, i - 3):i]):
            found.append("\n".join(lines[i:i + 6]))
    return found


def test_raw_rows_never_meet_in_one_window_task(people):
    for df in (
        ranking.surrogate_key(people, ["tag", "id"]),
        ranking.ntile(people, ["score", "id"], 4, "q"),
        ranking.global_rank(people, ["score"], [True]),
        ranking.global_rank(people, ["score"], [True], dense=True),
    ):
        # The only single-partition windows run over one row per range.
        for below in window_over_single_partition(plan_of(df)):
            assert "HashAggregate" in below and "_seq_range" in below


def test_top_rows_are_pruned_before_the_shuffle(people):
    plan = plan_of(ranking.top_rows(people, ["dept"], [F.col("id").desc()], 5))
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning"))
    assert "Partial" in plan[partial:].splitlines()[0]


def test_no_query_runs_python(spark, folder):
    for name, query in catalog.queries().items():
        plan = plan_of(query(spark, folder))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct"):
            assert node not in plan, (name, node)


def test_filters_reach_the_scans(spark, folder):
    plan = plan_of(catalog.queries()["fn_daily_avg"](spark, folder))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)
    plan = plan_of(catalog.queries()["fn_prefix_distinct"](spark, folder))
    assert plan.index("Join") < plan.index("Generate explode"), "the prefixes are matched below the join"
    plan = plan_of(catalog.queries()["range_violation"](spark, folder))
    assert "exists(" not in plan and "transform(" not in plan
    for name in ("median_by_rank", "agg_percentile", "pct_of_total", "fn_group_pct"):
        assert plan_of(catalog.queries()[name](spark, folder)).count(f"{folder}/") <= 1, name
