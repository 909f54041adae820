"""Stored sketches against exact counts, and tables replaced under their readers."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from wardlens.operators import sketches
from wardlens.sources import staging, versions


@pytest.fixture(scope="module")
def measured(spark):
    """40,000 values in two groups over twelve months, a group of NULLs, and rows without a time."""
    draw = F.rand(7)
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 5 == 0, "small").otherwise("large").alias("grp"),
        F.expr("timestamp'2024-01-01' + make_interval(0, cast(id % 12 AS int), 0, 3)").alias("at"),
        (draw * draw * 1000).alias("value"), (F.col("id") % 30_011).alias("who"),
    )
    odd = spark.createDataFrame(
        [("none", None, None, None), (None, None, 5.0, 1)], "grp string, at timestamp, value double, who long"
    )
    return staging.stage(rows.union(odd), "measured")


def test_percentiles_of_a_year_from_months(spark, measured):
    stored = staging.stage(sketches.period_sketches(measured, ["grp"], "at", "value"), "sketches")
    assert stored.filter("grp = 'large'").count() == 12 and stored.filter("period IS NULL").count() == 2
    wanted = {"low": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 0.99}
    got = {r.grp: r for r in sketches.merged_percentiles(stored, ["grp"], wanted).collect()}
    assert set(got) == {"small", "large", "none", None}
    assert got["none"].n == 0 and got["none"].median is None
    assert got[None].n == 1 and got[None].median == 5.0
    for name in ("small", "large"):
        values = sorted(r.value for r in measured.filter(F.col("grp") == name).collect())
        assert got[name].n == len(values)
        for out, q in wanted.items():
            assert abs(bisect.bisect_right(values, got[name][out]) / len(values) - q) < 0.003
    shares = {r.grp: r.share for r in sketches.rank_in_sketches(stored, ["grp"], 250.0).collect()}
    values = [r.value for r in measured.filter("grp = 'large'").collect()]
    assert abs(shares["large"] - sum(v <= 250 for v in values) / len(values)) < 0.003
    assert shares["none"] is None


def test_a_span_of_periods_is_asked_without_the_rows(spark, measured):
    stored = staging.stage(sketches.period_sketches(measured, ["grp"], "at", "value"), "sketches")
    half = stored.filter("period < timestamp'2024-07-01' AND grp = 'large'")
    got = sketches.merged_percentiles(half, ["grp"], {"median": 0.5}).first()
    exact = measured.filter("at < timestamp'2024-07-01' AND grp = 'large'")
    assert got.n == exact.count() > 0
    assert abs(exact.filter(F.col("value") <= got.median).count() / got.n - 0.5) < 0.003
    none = sketches.merged_percentiles(stored.limit(0), ["grp"], {"median": 0.5})
    assert none.count() == 0


def test_sets_are_combined_within_their_error(spark):
    draw = random.Random(3)
    sets = {"a": F.col("id") % 2 == 0, "b": F.col("id") % 3 == 0}
    table = spark.range(300_000).select((F.col("id") * 7919).alias("who"), "id", (F.col("id") % 5).alias("month"))
    twice = table.union(table.sample(0.3, draw.randrange(99)))
    stored = staging.stage(sketches.set_sketches(twice, ["month"], "who", sets), "sets")
    whole = sketches.merged_sets(stored, [], ["a", "b"])
    a, b = F.col("a"), F.col("b")
    got = whole.select(*(
        sketches.members(c).alias(n)
        for n, c in (("a", a), ("both", sketches.both(a, b)), ("only", sketches.only(a, b)), ("either", sketches.either(a, b)))
    )).first()
    want = {"a": 150_000, "both": 50_000, "only": 100_000, "either": 200_000}
    for name, n in want.items():  # three standard errors of the largest set
        assert abs(got[name] - n) <= 3 * 200_000 / 2**8, name


def test_small_sets_are_exact_and_null_members_are_in_none(spark):
    rows = [("x", 1, True, False), ("x", 1, False, True), ("x", 2, True, False), ("x", None, True, True), ("y", 3, None, False)]
    table = spark.createDataFrame(rows, "grp string, who long, a boolean, b boolean")
    found = sketches.set_sketches(table, ["grp"], "who", {"p": F.col("a"), "q": F.col("b")})
    p, q = F.col("p"), F.col("q")
    got = {r.grp: r for r in found.select(
        "grp", sketches.members(p).alias("p"), sketches.members(q).alias("q"), sketches.members(sketches.only(p, q)).alias("only")
    ).collect()}
    assert (got["x"].p, got["x"].q, got["x"].only) == (2, 1, 1)
    assert (got["y"].p, got["y"].q, got["y"].only) == (0, 0, 0)


@pytest.fixture
def root(spark):
    return staging.staging_path(spark, "versions")


def test_a_reader_keeps_its_version_during_a_load(spark, root):
    versions.replace_table(spark.range(10), root)
    reader = versions.open_table(spark, root)
    versions.replace_table(reader.filter("id < 3").union(spark.range(100, 102)), root)
    assert reader.count() == 10
    assert sorted(r.id for r in versions.open_table(spark, root).collect()) == [0, 1, 2, 100, 101]
    assert versions.open_table(spark, root, back=1).count() == 10


def test_a_failed_load_leaves_the_table(spark, root):
    versions.replace_table(spark.range(10), root)
    broken = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(broken, root)
    assert len(versions.committed(spark, root)) == 1
    assert versions.open_table(spark, root).count() == 10
    versions.replace_table(spark.range(4).selectExpr("id", "'x' AS more"), root)
    assert versions.open_table(spark, root).columns == ["id", "more"]
    assert len(versions.drop_versions(spark, root, keep=1)) == 2  # the first one and what the failed load left
    assert versions.open_table(spark, root).count() == 4


def test_old_versions_go(spark, root):
    for n in range(4):
        versions.replace_table(spark.range(n), root)
    assert len(versions.drop_versions(spark, root, keep=2)) == 2
    assert [versions.open_table(spark, root, back).count() for back in (0, 1)] == [3, 2]
    with pytest.raises(ValueError):
        versions.open_table(spark, root, back=2)
    with pytest.raises(ValueError):
        versions.drop_versions(spark, root, keep=0)
    assert versions.drop_versions(spark, root + "-none") == []
