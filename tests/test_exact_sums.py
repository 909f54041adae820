"""Running sums and means of any doubles against exact arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from wardlens.functions.exact_sums import ALL_DOUBLES, addends, total, words_for
from wardlens.operators import windows
from wardlens.operators.sequences import along


def rows_of(kind, n, seed=1):
    rng = random.Random(seed)
    draw = {
        "usual": lambda: round(rng.uniform(-1000, 1000), 2),
        "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300),
        "tiny": lambda: rng.uniform(0, 3e-13),
        "least": lambda: rng.choice([5e-324, -2.5e-310, 1e-320]),
        "large": lambda: rng.choice([1e25, -1e25, 3.0]),
    }[kind]
    return [(i, i % 3 if i % 4 else 9, draw() if rng.random() < 0.9 else None) for i in range(n)]


def close(got, exact):
    return exact == 0 and abs(got) < 1e-300 or abs(Fraction(got) - exact) <= abs(exact) * Fraction(1, 2**51) + Fraction(5e-324)


@pytest.mark.parametrize("kind", ["usual", "wide", "tiny", "least", "large"])
def test_running_sums_are_exact_and_equal_for_every_limit(spark, kind):
    rows = rows_of(kind, 400)
    df = spark.createDataFrame(rows, "id long, key int, value double").cache()
    found = [
        sorted((r.id, r.s) for r in along(df, ["key"], ["id"], running={"s": ("sum", "value")}, max_group_rows=limit).collect())
        for limit in (40, 10**6)
    ]
    assert found[0] == found[1]
    sums = {}
    for (i, got), (_, key, value) in zip(found[0], rows):
        if value is not None:
            sums[key] = sums.get(key, 0) + Fraction(value)
        assert got is None if key not in sums else close(got, sums[key]), (i, got)


def test_unusual_values_as_the_oracle_has_them(spark):
    nan, inf = math.nan, math.inf
    cases = {1: [nan, 1.0], 2: [1.0, nan, 2.0], 3: [inf, 1.0], 4: [inf, -inf], 5: [-inf, None], 6: [None, 1e-13, 3e-13], 7: [1e25, 1e25]}
    rows = [(k, i, v) for k, values in cases.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key int, i int, value double")
    got = {(r.key, r.i): r.mean for r in windows.running_mean(df, ["key"], ["i"], "value", "mean").collect()}
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE r (key INT, i INT, value DOUBLE)")
    con.executemany("INSERT INTO r VALUES (?, ?, ?)", rows)
    for key, i, mean in con.execute(
        "SELECT key, i, sum(value) OVER w / count(value) OVER w FROM r "
        "WINDOW w AS (PARTITION BY key ORDER BY i ROWS UNBOUNDED PRECEDING)"
    ).fetchall():
        if mean is None or math.isnan(mean):
            assert got[key, i] is None if mean is None else math.isnan(got[key, i]), (key, i)
        else:
            assert got[key, i] == pytest.approx(mean, rel=1e-15)


def test_words_of_all_doubles_add_up_to_the_value(spark):
    values = [0.0, -0.0, 1.5, -7.25e-300, 1.7976931348623157e308, 5e-324, 2**53 + 1.0, 0.1, -123456.789]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    for words in (ALL_DOUBLES, words_for(df, {"x": F.col("x")})["x"]):
        sums = df.groupBy("i").agg(*[F.sum(a).alias(f"w{k}") for k, a in enumerate(addends(F.col("x"), words))])
        n = words.count + 3 * words.special
        got = {r.i: r.x for r in sums.select("i", total([F.col(f"w{k}") for k in range(n)], words).alias("x")).collect()}
        assert [got[i] for i in range(len(values))] == values


def test_derived_doubles_and_few_words(spark):
    df = spark.createDataFrame(rows_of("usual", 300), "id long, key int, value double")
    made = along(
        df, ["key"], ["id"], shifts={"p": ("value", 1)}, derive=lambda d: d.withColumn("step", F.col("value") - F.col("p")),
        running={"s": ("sum", "step"), "n": ("count", "step")}, max_group_rows=20,
    )
    plain = along(df, ["key"], ["id"], shifts={"p": ("value", 1)}).withColumn("step", F.col("value") - F.col("p"))
    want = along(plain, ["key"], ["id"], running={"s": ("sum", "step"), "n": ("count", "step")})
    assert sorted((r.id, r.s, r.n) for r in made.collect()) == sorted((r.id, r.s, r.n) for r in want.collect())
    assert words_for(df, {"v": F.col("value")})["v"].count <= 3


def test_no_values_at_all(spark):
    df = spark.createDataFrame([(1, None)], "key int, value double")
    assert along(df, ["key"], ["value"], running={"s": ("sum", "value")}).first().s is None
    assert along(df.limit(0), ["key"], ["value"], running={"s": ("sum", "value")}).collect() == []
