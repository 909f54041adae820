"""Windows, ranks, top-k and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlens.functions import dates, numbers
from wardlens.operators import filters, ranking, sampling, windows
from wardlens.plans.registry import Tables, query, rounded


@query(
    "topn_row_number",
    """SELECT o_custkey, o_orderkey, row_no FROM (SELECT *, row_number() OVER
         (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS row_no FROM orders)
       WHERE row_no <= 5""",
)
def topn_row_number(t: Tables):
    latest = ranking.top_rows(
        t.orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")], 5
    )
    return latest.select("o_custkey", "o_orderkey", "row_no")


@query(
    "topn_rank",
    """SELECT p_partkey, p_type, p_size FROM (SELECT *, rank() OVER
         (PARTITION BY p_type ORDER BY p_size DESC) AS r FROM part) WHERE r = 1""",
)
def topn_rank(t: Tables):
    return ranking.top_values(t.part, ["p_type"], "p_size").select("p_partkey", "p_type", "p_size")


@query(
    "topn_rank_ties",
    """SELECT p_partkey, p_brand, p_size, r AS rank FROM (SELECT *, rank() OVER
         (PARTITION BY p_brand ORDER BY p_size DESC) AS r FROM part) WHERE r <= 4""",
)
def topn_rank_ties(t: Tables):
    return ranking.top_values(t.part, ["p_brand"], "p_size", 4).select(
        "p_partkey", "p_brand", "p_size", "rank"
    )


@query(
    "topn_dense_rank",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity, r AS rank
       FROM (SELECT *, dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS r
             FROM lineitem) WHERE r <= 3""",
)
def topn_dense_rank(t: Tables):
    best = ranking.top_values(t.lineitem, ["l_returnflag"], "l_quantity", 3, dense=True)
    return best.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "rank"
    )


@query(
    "nth_distinct",
    """SELECT p_partkey, p_size FROM (SELECT *, dense_rank() OVER (ORDER BY p_size) AS r FROM part)
       WHERE r = 9""",
)
def nth_distinct(t: Tables):
    return ranking.nth_distinct(t.part, "p_size", 9).select("p_partkey", "p_size")


@query(
    "rank_global",
    """SELECT c_custkey, rank() OVER (ORDER BY c_nationkey DESC, c_mktsegment) AS rank,
              dense_rank() OVER (ORDER BY c_acctbal DESC) AS balance_rank FROM customer""",
)
def rank_global(t: Tables):
    customers = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    ranked = ranking.global_rank(customers, ["c_nationkey", "c_mktsegment"], [True, False])
    ranked = ranking.global_rank(ranked, ["c_acctbal"], [True], "balance_rank", dense=True)
    return ranked.select("c_custkey", "rank", "balance_rank")


@query(
    "rank_of_agg",
    """SELECT o_custkey, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS rank
       FROM orders GROUP BY 1""",
)
def rank_of_agg(t: Tables):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return ranking.global_rank(counts, ["n"], [True])


@query(
    "lag_lead",
    """SELECT event_id, lag(event_type) OVER w AS previous, lead(event_type) OVER w AS next,
              lag(event_type, 3) OVER w AS third
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def lag_lead(t: Tables):
    rows = windows.neighbours(
        t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"],
        {"previous": ("event_type", 1), "next": ("event_type", -1), "third": ("event_type", 3)},
    )
    return rows.select("event_id", "previous", "next", "third")


@query(
    "lag_diff",
    """SELECT event_id, value, lag(value) OVER w AS previous, value - lag(value) OVER w AS difference
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def lag_diff(t: Tables):
    rows = windows.difference(
        t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"],
        "value", "previous", "difference",
    )
    return rows.select("event_id", "value", "previous", "difference")


@query(
    "pct_jump",
    f"""SELECT event_id, previous, {rounded("(value - previous) * 100.0 / previous", 4)} AS pct FROM
          (SELECT *, nullif(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS previous
           FROM events) WHERE (value - previous) * 100.0 / previous > 30""",
)
def pct_jump(t: Tables):
    rows = windows.percent_jumps(
        t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"],
        "value", 30, "previous", "pct",
    )
    return rows.select("event_id", "previous", numbers.round_half_up(F.col("pct"), 4).alias("pct"))


@query(
    "decline_3_days",
    f"""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS v FROM events GROUP BY 1, 2),
        l AS (SELECT *, lag(v, 1) OVER w AS v1, lag(v, 2) OVER w AS v2,
                     lag(day, 1) OVER w AS d1, lag(day, 2) OVER w AS d2
              FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day))
        SELECT user_id, strftime(day, '%Y-%m-%d') AS day, {rounded("v", 6)} AS mean_value,
               {rounded("v1", 6)} AS previous_1, {rounded("v2", 6)} AS previous_2
        FROM l WHERE v < v1 AND v1 < v2 AND d1 = day - 1 AND d2 = day - 2""",
)
def decline_3_days(t: Tables):
    daily = windows.daily_mean(t.events, ["user_id"], "ts", {"v": "value"})
    falls = windows.falling_days(daily, ["user_id"], "day", ["v"], 3)
    return falls.select(
        "user_id", F.date_format("day", "yyyy-MM-dd").alias("day"),
        numbers.round_half_up(F.col("v"), 6).alias("mean_value"),
        numbers.round_half_up(F.col("v_prev1"), 6).alias("previous_1"),
        numbers.round_half_up(F.col("v_prev2"), 6).alias("previous_2"),
    )


@query(
    "equal_runs",
    """SELECT user_id, event_type, count(*) AS readings, min(ts) AS first_time, max(ts) AS last_time
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                     - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g
             FROM events) GROUP BY user_id, event_type, g HAVING count(*) > 2""",
)
def equal_runs(t: Tables):
    runs = windows.equal_runs(
        t.events.select("event_id", "user_id", "ts", "event_type"),
        ["user_id"], ["ts", "event_id"], "event_type", 2, "ts",
    )
    return runs.select("user_id", "event_type", "readings", "first_time", "last_time")


@query(
    "equal_day_runs",
    """WITH d AS (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events),
       g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY day) AS INT)
               AS island FROM d)
       SELECT user_id, event_type, count(*) AS days, strftime(min(day), '%Y-%m-%d') AS first_day,
              strftime(max(day), '%Y-%m-%d') AS last_day
       FROM g GROUP BY user_id, event_type, island HAVING count(*) > 2""",
)
def equal_day_runs(t: Tables):
    runs = windows.equal_day_runs(t.events, ["user_id"], "ts", "event_type", 2)
    return runs.select(
        "user_id", "event_type", "days",
        F.date_format("first_day", "yyyy-MM-dd").alias("first_day"),
        F.date_format("last_day", "yyyy-MM-dd").alias("last_day"),
    )


@query(
    "running_avg",
    f"""SELECT event_id, {rounded('''avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''', 4)} AS running FROM events""",
)
def running_avg(t: Tables):
    rows = windows.running_mean(
        t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"],
        "value", "running",
    )
    return rows.select("event_id", numbers.round_half_up(F.col("running"), 4).alias("running"))


@query(
    "running_max",
    """SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY date_trunc('hour', ts)) AS peak
       FROM events""",
)
def running_max(t: Tables):
    events = t.events.select(
        "event_id", "user_id", F.date_trunc("hour", "ts").alias("hour"), "value"
    )
    return windows.running_max(events, ["user_id"], "hour", "value", "peak").select(
        "event_id", "peak"
    )


@query(
    "moving_avg_3m",
    f"""SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, count(*) AS n,
               {rounded("avg(count(*)) OVER (ORDER BY date_trunc('month', o_orderdate) ROWS 2 PRECEDING)", 2)}
                 AS moving FROM orders GROUP BY 1, date_trunc('month', o_orderdate)""",
)
def moving_avg_3m(t: Tables):
    months = windows.period_counts(t.orders, dates.month_start(F.col("o_orderdate")), "month")
    moved = windows.moving_mean(months, "month", "n", 3, "moving")
    return moved.withColumn("moving", numbers.round_half_up(F.col("moving"), 2))


@query(
    "prev_next_period",
    """SELECT month(o_orderdate) AS month, count(*) AS n,
              coalesce(lag(count(*)) OVER (ORDER BY month(o_orderdate)), 0) AS previous,
              coalesce(lead(count(*)) OVER (ORDER BY month(o_orderdate)), 0) AS next
       FROM orders GROUP BY 1""",
)
def prev_next_period(t: Tables):
    months = windows.period_counts(t.orders, F.month("o_orderdate"), "month")
    return windows.over_periods(
        months, "month", previous=F.lag("n", 1, 0), next=F.lead("n", 1, 0)
    )


@query(
    "active_day_gap",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders
                  WHERE o_orderdate >= '1996-03-01' AND o_orderdate < '1996-04-01'
                    AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY 1)
       SELECT strftime(day, '%Y-%m-%d') AS day, n, CAST(day - lag(day) OVER (ORDER BY day) AS BIGINT) AS gap
       FROM d""",
)
def active_day_gap(t: Tables):
    march = t.orders.filter(
        filters.date_range("o_orderdate", "1996-03-01", "1996-04-01")
        & (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    )
    days = windows.period_counts(march, F.to_date("o_orderdate"), "day")
    gaps = windows.over_periods(days, "day", before=F.lag("day", 1))
    return gaps.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "n",
        F.datediff("day", "before").alias("gap"),
    )


@query(
    "ntile_4",
    """SELECT c_custkey, c_acctbal, ntile(4) OVER (ORDER BY c_acctbal, c_custkey) AS quartile
       FROM customer""",
)
def ntile_4(t: Tables):
    return ranking.ntile(
        t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], 4, "quartile"
    )


@query(
    "partition_count",
    """SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""",
)
def partition_count(t: Tables):
    return windows.partition_count(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "n").select(
        "o_orderkey", "n"
    )


@query(
    "state_transition",
    f"""SELECT event_id, user_id, ts, next_state,
               {rounded("(epoch_us(ts) - epoch_us(previous_time)) / 3600e6", 4)} AS hours
        FROM (SELECT *, lag(event_type) OVER w AS p, lead(event_type) OVER w AS next_state,
                     lag(ts) OVER w AS previous_time
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE p = 'view' AND event_type = 'purchase'""",
)
def state_transition(t: Tables):
    rows = windows.state_transitions(
        t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"],
        ["ts", "event_id"], "event_type", "view", "purchase",
        carry={"next_state": ("event_type", -1), "previous_time": ("ts", 1)},
    )
    hours = dates.hours_between(F.col("previous_time"), F.col("ts"))
    return rows.select(
        "event_id", "user_id", "ts", "next_state", numbers.round_half_up(hours, 4).alias("hours")
    )


@query("sort_multi", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY 2, 3 DESC, 1")
def sort_multi(t: Tables):
    return t.customer.select("c_custkey", "c_nationkey", "c_acctbal").orderBy(
        F.col("c_nationkey").asc_nulls_last(), F.col("c_acctbal").desc_nulls_first(), "c_custkey"
    )


@query(
    "top_k",
    """SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""",
)
def top_k(t: Tables):
    return t.orders.select("o_orderkey", "o_orderdate").orderBy(
        F.col("o_orderdate").desc(), "o_orderkey"
    ).limit(100)


@query(
    "limit_offset",
    """SELECT DISTINCT p_retailprice FROM part ORDER BY p_retailprice LIMIT 1 OFFSET 2""",
)
def limit_offset(t: Tables):
    return t.part.select("p_retailprice").distinct().orderBy("p_retailprice").offset(2).limit(1)


@query(
    "random_n",
    """SELECT c_custkey, c_mktsegment FROM customer
       ORDER BY md5('seed1:' || c_custkey), c_custkey LIMIT 10""",
)
def random_n(t: Tables):
    return sampling.random_rows(t.customer, ["c_custkey"], 10, "seed1").select(
        "c_custkey", "c_mktsegment"
    )


def draw(seed: str, key: str) -> str:
    """SQL for the uniform number of a key."""
    return f"((CAST('0x' || substr(md5('{seed}:' || {key}), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"


@query(
    "random_in_range",
    f"""SELECT c_custkey, band, CAST(low + floor({draw("seed2", "c_custkey")} * 9) AS BIGINT) AS age
        FROM (SELECT c_custkey, 21 + 10 * (c_nationkey % 5) AS low,
                     (21 + 10 * (c_nationkey % 5)) || '-' || (29 + 10 * (c_nationkey % 5)) AS band
              FROM customer)""",
)
def random_in_range(t: Tables):
    low = F.lit(21) + F.col("c_nationkey") % 5 * 10
    banded = t.customer.select(
        "c_custkey", F.concat_ws("-", low.cast("string"), (low + 8).cast("string")).alias("band")
    )
    return banded.withColumn(
        "age", sampling.random_in_text_range(F.col("band"), F.col("c_custkey"), "seed2")
    )


@query(
    "normal_sample",
    f"""SELECT c_custkey, CAST(round((SELECT DISTINCT p_size FROM part ORDER BY 1 LIMIT 1 OFFSET 2)
          + 3 * sqrt(-2 * ln({draw("seed3r", "c_custkey")})) * cos(2 * pi() * {draw("seed3a", "c_custkey")}))
          AS BIGINT) AS size FROM customer""",
)
def normal_sample(t: Tables):
    third = t.part.select("p_size").distinct().orderBy("p_size").offset(2).limit(1).scalar()
    drawn = sampling.normal_draw(third, 3.0, F.col("c_custkey"), "seed3")
    return t.customer.select("c_custkey", F.round(drawn).cast("bigint").alias("size"))
