"""Column functions on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardlens.functions import dates, numbers, text
from wardlens.operators import aggregates, crosstabs, filters, reports, sampling
from wardlens.sources import inline


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def value(one, column):
    return one.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "hour, slot",
    [(0, "12AM - 1AM"), (1, "1AM - 2AM"), (9, "9AM - 10AM"), (10, "10AM - 11AM"), (11, "11AM - 12PM"),
     (12, "12PM - 1PM"), (13, "1PM - 2PM"), (22, "10PM - 11PM"), (23, "11PM - 12AM")],
)
def test_hour_slot(one, hour, slot):
    assert value(one, dates.hour_slot(F.lit(hour))) == slot


@pytest.mark.parametrize("month, name", [(12, "Winter"), (1, "Winter"), (2, "Winter"), (3, "Spring"),
                                         (6, "Summer"), (9, "Fall"), (11, "Fall")])
def test_season(one, month, name):
    assert value(one, dates.season(F.lit(dt.datetime(2020, month, 28)))) == name


def test_time_of_day_is_inclusive(spark):
    times = ["03:59:59.999999", "04:00:00", "04:30:00", "05:00:00", "05:00:00.000001"]
    df = spark.createDataFrame([(f"2020-01-01 {t}",) for t in times], "s string")
    df = df.withColumn("ts", F.col("s").cast("timestamp_ntz"))
    kept = df.filter(dates.within_time_of_day(F.col("ts"), "04:00:00", "05:00:00"))
    assert [r["s"][11:] for r in kept.orderBy("s").collect()] == times[1:4]


def test_durations(one):
    a, b = F.lit(dt.datetime(2020, 12, 31, 23, 59)), F.lit(dt.datetime(2021, 1, 2, 0, 0))
    assert value(one, dates.calendar_days_between(a, b)) == 2
    assert value(one, dates.whole_days_between(a, b)) == 1
    assert value(one, dates.whole_days_between(b, a)) == -1
    assert value(one, numbers.round_half_up(dates.hours_between(a, b), 4)) == 24.0167
    assert value(one, dates.weekday_name(a)) == "Thursday"
    assert value(one, dates.day_of_week(F.lit(dt.date(2021, 1, 3)))) == 0


@pytest.mark.parametrize("x, digits, up, cut", [(1.005, 2, 1.01, 1.0), (-1.005, 2, -1.01, -1.0),
                                               (2.999, 1, 3.0, 2.9), (-2.99, 1, -3.0, -2.9), (7.0, 2, 7.0, 7.0)])
def test_rounding(one, x, digits, up, cut):
    assert value(one, numbers.round_half_up(F.lit(x), digits)) == up
    assert value(one, numbers.truncate(F.lit(x), digits)) == cut


def test_ratios_guard_zero(one):
    assert value(one, numbers.guarded_ratio(F.lit(1), F.lit(0))) is None
    assert value(one, numbers.percent(F.lit(1), F.lit(0))) is None
    assert value(one, numbers.percent(F.lit(1), F.lit(3))) == 33.33
    assert value(one, numbers.whole_quotient(F.lit(-7), F.lit(2))) == -3


@pytest.mark.parametrize("x, label", [(None, "Null"), (-3, "Odd"), (0, "Even"), (4, "Even")])
def test_parity(one, x, label):
    assert value(one, numbers.parity_label(F.lit(x).cast("int"))) == label


def test_bands_and_score(one):
    bands = [(None, 30, 3), (30, 40, 2), (40, 50, 1)]
    for x, points in [(29.9, 3), (30, 2), (39.99, 2), (40, 1), (50, 0)]:
        assert value(one, numbers.score(F.lit(float(x)), bands)) == points
    assert value(one, numbers.score(F.lit(None).cast("double"), bands)) == 0
    assert value(one, numbers.band(F.lit(-0.5), 5)) == -1
    assert value(one, numbers.band(F.lit(5.0), 5)) == 1


@pytest.mark.parametrize(
    "found, reference, outside",
    [("12", "3--10", True), ("2.5", "3～10", True), ("3", "3--10", False), ("10", "3～10", False),
     ("1.2.3", "3--10", False), ("<5", "3--10", False), ("", "3--10", False), (None, "3--10", False),
     ("12", "abc", False), ("12", None, False), ("12", "3--10--4", False), ("12", "a--10", False),
     ("12", "--10", False), (".5", "1.0--2.", True), (".", "1--2", False)],
)
def test_outside_range(one, found, reference, outside):
    rows = one.select(F.lit(found).cast("string").alias("v"), F.lit(reference).cast("string").alias("r"))
    assert numbers.outside_range(rows, F.col("v"), F.col("r"), ["--", "～"]).count() == int(outside)


def test_text(one):
    none = F.lit(None).cast("string")
    assert value(one, text.concat_skip_null(F.lit("a"), none, F.lit("b"))) == "ab"
    assert value(one, text.csv_line(F.lit(1), none, F.lit("x"))) == "1, N/A, x"
    assert value(one, text.nth_part(F.lit("Aspirin"), " ", 2)) == ""
    assert value(one, text.last_chars(F.lit("abc"), 6)) is None
    assert value(one, text.last_chars(F.lit("abcdefgh"), 6)) == "cdefgh"
    assert value(one, text.zero_pad(F.lit(857781), 12)) == "000000857781"
    assert value(one, text.position_of(F.lit("abc"), "y")) == 0
    assert value(one, text.text_bar(F.lit(85), F.lit(200), per_mark=40)) == "▰▰"
    assert value(one, text.text_bar(F.lit(85), F.lit(170), 10)) == "▰" * 5
    huge = F.lit(4 * 10**12)
    assert value(one, text.text_bar(huge, huge, 30, per_mark=40)) == "▰" * 30
    assert value(one, text.text_bar(F.lit(0), F.lit(0))) == ""
    assert value(one, text.bits_and_chars(F.lit("é"))[0]) == 16
    assert value(one, text.bits_and_chars(F.lit("é"))[1]) == 8
    ranks = {"1_Much better now": 1, "④比1年前差一些": 4}
    assert value(one, text.rank_of_label(F.lit("④比1年前差一些"), ranks)) == 4
    assert value(one, text.rank_of_label(F.lit("other"), ranks)) is None


def test_json_keeps_null(one):
    assert value(one, numbers.json_object(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))) == '{"a":1,"b":null}'


def test_palindromes(spark):
    words = spark.createDataFrame([(w,) for w in "mom dad brother noon sister girl".split()], "w string")
    found = {r["w"] for r in words.filter(text.is_palindrome(F.col("w"))).collect()}
    assert found == {"mom", "dad", "noon"}


def test_correlation_without_variance_is_null(spark):
    df = spark.createDataFrame(
        [("flat", 1.0, 2.0), ("flat", 1.0, 3.0), ("one", 1.0, 1.0), ("up", 1.0, 2.0), ("up", 2.0, 4.0),
         ("up", None, 9.0)], "k string, y double, x double")
    got = {r["k"]: r["c"] for r in df.groupBy("k").agg(
        aggregates.correlation(F.col("y"), F.col("x")).alias("c")).collect()}
    assert got["flat"] is None and got["one"] is None and got["up"] == pytest.approx(1.0)
    long = aggregates.correlations(df, ["k"], {"p": (F.col("y"), F.col("x"))}).collect()
    assert {r["k"]: r["correlation"] for r in long} == got


def test_shares_sum_to_hundred(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)] * 3, "g string")
    shares = aggregates.share_of_total(df, ["g"])
    assert shares.agg(F.sum("pct")).first()[0] == 100.0
    assert sorted(map(repr, shares.collect())) == sorted(map(repr, aggregates.share_of_counted(df, ["g"]).collect()))


def test_filtered_percent_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "v string")
    got = aggregates.filtered_percent(empty, F.col("v") == "x", F.col("v").isNotNull(), "pct")
    assert got.first()["pct"] == 0.0


def test_crosstab_leaves_missing_cells_null(spark):
    df = spark.createDataFrame([("p", "ICU"), ("p", "ICU"), ("q", "Surgery")], "id string, dept string")
    got = crosstabs.crosstab(df, ["id"], "dept", {"ICU": "dpt1", "Surgery": "dpt2"}).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("p", 2, None), ("q", None, 1)]


def test_null_safe_anti_join(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r["k"] for r in filters.without_keys(left, right, ["k"]).collect()] == [2]


def test_sharing_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "a", 11), (1, "b", 10), (2, "a", 5), (2, "a", 5)],
                               "k int, d string, o int")
    got = filters.sharing_duplicates(df, ["k", "d"], "o").collect()
    assert sorted(r["o"] for r in got) == [10, 11]


def test_prefix_counts_include_zero(spark):
    df = spark.createDataFrame([("Aspirin", 1), ("Aspirin", 1), ("Aspartame", 2)], "d string, id int")
    got = {r["prefix"]: r["n"] for r in reports.distinct_by_prefix(df, "d", ["Asp", "Aspi", "Zz"], "id").collect()}
    assert got == {"Asp": 2, "Aspi": 1, "Zz": 0}


def test_series_quotient_equals_division(spark):
    data = [(0, 3), (7, 2), (9, 3), (10, 11), (-5, 2), (-6, -4), (4, -1), (3, 0), (None, 1)]
    df = spark.createDataFrame(data, "a int, b int")
    for r in df.select("a", "b", inline.series_quotient(F.lit(0), F.col("a"), F.col("b")).alias("q")).collect():
        empty = r["a"] is None or r["b"] == 0 or r["a"] * r["b"] < 0
        assert r["q"] == (None if empty else r["a"] // r["b"])
    rows = inline.expand_series(df.filter("b <> 0"), F.lit(0), F.col("a"), F.col("b"), "x")
    assert rows.count() == sum(a // b + 1 for a, b in data if b and a is not None and a * b >= 0)


def test_rounding_and_means_hold_for_any_value(spark, one):
    assert value(one, numbers.round_half_up(F.lit(1e30), 2)) == 1e30
    assert value(one, numbers.round_half_up(F.lit(2.5e-12), 12)) == 3e-12
    assert value(one, numbers.round_half_up(F.lit(2.675), 2)) == 2.68
    assert value(one, numbers.truncate(F.lit(-1e30), 2)) == -1e30
    df = spark.createDataFrame([(0.0001,), (0.0002,), (0.0004,), (1e15,), (-1e15,)], "v double")
    assert df.agg(aggregates.exact_mean(F.col("v"), 6, scale=4)).first()[0] == 0.00014


def test_draws_repeat_and_stay_in_range(spark):
    df = spark.range(2000)
    age = sampling.random_in_text_range(F.lit("21-29"), F.col("id"), "s").alias("age")
    first = {r["id"]: r["age"] for r in df.repartition(5).select("id", age).collect()}
    assert first == {r["id"]: r["age"] for r in df.coalesce(1).select("id", age).collect()}
    assert set(first.values()) == set(range(21, 30))
    z = df.select(sampling.normal_draw(F.lit(50.0), 3.0, F.col("id"), "n").alias("z"))
    mean, sd = z.agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean - 50) < 0.3 and abs(sd - 3) < 0.2


def test_durations_do_not_depend_on_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([("2021-03-28 00:30:00", "2021-03-28 04:30:00.25")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    seen = set()
    try:
        for name in ("UTC", "Europe/Berlin", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", name)
            row = df.select(
                dates.micros(F.col("b")).alias("m"), dates.hours_between(F.col("a"), F.col("b")).alias("h"),
                dates.month_start(F.col("a")).alias("s"), dates.seconds_of_day(F.col("b")).alias("d"),
            ).first()
            seen.add(tuple(row))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    micros = int(dt.datetime(2021, 3, 28, 4, 30, 0, 250000, dt.timezone.utc).timestamp() * 1e6)
    assert seen == {(micros, 4 + 0.25 / 3600, dt.datetime(2021, 3, 1), 16200.25)}


def test_sketches_stay_near_the_exact_numbers(spark):
    from wardlens.operators.percentiles import approximate_percentiles

    df = spark.range(20000).withColumn("g", F.col("id") % 2)
    near = df.groupBy("g").agg(aggregates.distinct_count("id", 0.02).alias("n")).collect()
    assert all(abs(r["n"] - 10000) < 1000 for r in near)
    half = approximate_percentiles(df, ["g"], "id", {"m": 0.5}).collect()
    assert all(abs(r["m"] - 10000) < 50 for r in half)


def test_set_operations_drop_copies(spark):
    from wardlens.operators import setops

    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([("a", 1), ("a", 1), ("c", None)], "v string, k int")
    assert sorted(map(repr, setops.intersect(left, right).select("k", "v").collect())) == [
        "Row(k=1, v='a')", "Row(k=None, v='c')"]
    assert [tuple(r) for r in setops.minus(left, right).select("k", "v").collect()] == [(2, "b")]
    assert setops.union_all(left, right).count() == 7
    assert setops.union_distinct(left, right).count() == 3
