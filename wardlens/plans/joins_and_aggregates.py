"""Joins, grouped aggregates, crosstabs and set operations."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from wardlens.functions import dates, numbers, text
from wardlens.operators import (
    aggregates, crosstabs, filters, joins, percentiles, ranking, setops, sketches, windows,
)
from wardlens.plans.registry import Tables, query, rounded
from wardlens.sources.staging import stage


@query(
    "join_inner",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(t: Tables):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name"
    )


@query(
    "join_comma",
    "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def join_comma(t: Tables):
    return t.spark.sql(
        "SELECT c_custkey, n_name FROM {customer} c, {nation} n WHERE c.c_nationkey = n.n_nationkey",
        customer=t.customer, nation=t.nation,
    )


@query(
    "join_multiway",
    f"""SELECT r_name, c_mktsegment, count(*) AS lines,
               {rounded("sum(l_extendedprice * (1 - l_discount))", 2)} AS revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2""",
)
def join_multiway(t: Tables):
    joined = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return joined.groupBy("r_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("lines"), numbers.round_half_up(revenue, 2).alias("revenue")
    )


@query(
    "join_left",
    """SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN
         (SELECT o_custkey, count(*) AS n FROM orders
          WHERE o_orderstatus = 'F' AND o_totalprice > 400000 GROUP BY 1) ON c_custkey = o_custkey""",
)
def join_left(t: Tables):
    large = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000))
    counts = large.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )
    return joins.left_or(t.customer.select("c_custkey"), counts, ["c_custkey"], {"n_orders": 0})


@query(
    "join_scalar_broadcast",
    f"""SELECT o_orderkey, o_totalprice, {rounded("m", 4)} AS mean_price
        FROM orders, (SELECT avg(o_totalprice) AS m FROM orders) WHERE o_totalprice > m""",
)
def join_scalar_broadcast(t: Tables):
    return filters.above_mean(t.orders, "o_totalprice", "mean").select(
        "o_orderkey", "o_totalprice",
        numbers.round_half_up(F.col("mean"), 4).alias("mean_price"),
    )


@query(
    "join_within_days",
    """WITH p AS (SELECT a.o_orderkey, b.o_orderdate AS d FROM orders a JOIN orders b
                  ON a.o_custkey = b.o_custkey AND b.o_orderdate > a.o_orderdate
                 AND b.o_orderdate <= a.o_orderdate + INTERVAL 30 DAY)
       SELECT o.o_orderkey, count(p.d) AS followers, min(p.d) AS next_time,
              CAST(date_diff('day', any_value(o.o_orderdate), min(p.d)) AS BIGINT) AS diff_in_days
       FROM orders o LEFT JOIN p ON o.o_orderkey = p.o_orderkey GROUP BY 1""",
)
def join_within_days(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    found = joins.within_days(
        orders, orders, ["o_custkey"], "o_orderkey", "o_orderdate", "o_orderkey", "o_orderdate", 30
    )
    return found.select(
        "o_orderkey", "followers", "next_time",
        dates.calendar_days_between(F.col("o_orderdate"), F.col("next_time")).alias("diff_in_days"),
    )


@query(
    "follow_up_rows",
    """SELECT o_orderkey, follower, next_key, next_price, next_time FROM (
         SELECT a.o_orderkey, b.o_orderkey AS next_key, b.o_totalprice AS next_price, b.o_orderdate AS next_time,
                row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_orderdate, b.o_orderkey) AS follower
         FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate > a.o_orderdate
                                    AND b.o_orderdate <= a.o_orderdate + INTERVAL 90 DAY) WHERE follower <= 3""",
)
def follow_up_rows(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    found = joins.first_followers(
        orders, orders, ["o_custkey"], "o_orderkey", "o_orderdate", "o_orderkey", "o_orderdate", 90, 3,
        {"next_key": "o_orderkey", "next_price": "o_totalprice", "next_time": "o_orderdate"},
    )
    return found.select("o_orderkey", "follower", "next_key", "next_price", "next_time")


@query(
    "follow_up_chains",
    """WITH RECURSIVE follows AS (
         SELECT a.o_orderkey AS source, b.o_orderkey AS target,
                row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_orderdate, b.o_orderkey) AS n
         FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate > a.o_orderdate
                                    AND b.o_orderdate <= a.o_orderdate + INTERVAL 60 DAY),
       way(node, hops) AS (
         SELECT o_orderkey, 0 FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000
         UNION SELECT target, hops + 1 FROM way JOIN follows ON source = node WHERE n <= 2)
       SELECT node AS o_orderkey, min(hops) AS hops FROM way GROUP BY 1""",
)
def follow_up_chains(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    follows = joins.first_followers(
        orders, orders, ["o_custkey"], "o_orderkey", "o_orderdate", "o_orderkey", "o_orderdate", 60, 2,
        {"next_key": "o_orderkey"},
    )
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000)
    seeds = t.orders.filter(urgent).select("o_orderkey")
    return joins.reached(follows, seeds, "o_orderkey", "next_key", "o_orderkey", "hops")


@query(
    "join_self_dup",
    """SELECT DISTINCT a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_suppkey
       FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey
        AND a.l_linenumber = b.l_linenumber AND a.l_partkey <> b.l_partkey""",
)
def join_self_dup(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return filters.sharing_duplicates(lines, ["l_orderkey", "l_linenumber"], "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    "join_expr_key",
    """SELECT c_custkey, n_regionkey FROM customer JOIN nation
         ON lower('NATION_' || c_nationkey) = lower(n_name)""",
)
def join_expr_key(t: Tables):
    left = F.lower(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
    return joins.join_on_expression(t.customer, t.nation, left, F.lower("n_name")).select(
        "c_custkey", "n_regionkey"
    )


@query(
    "join_preagg",
    """SELECT c_mktsegment, CAST(sum(n) AS BIGINT) AS lines, count(*) AS orders
       FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def join_preagg(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    joined = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.groupBy("c_mktsegment").agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("orders")
    )


@query(
    "recursive_chain",
    """WITH RECURSIVE s AS (SELECT user_id, event_type,
                row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
       chain AS (SELECT user_id, n, event_type AS path FROM s WHERE n = 1
                 UNION ALL
                 SELECT s.user_id, s.n, chain.path || '>' || s.event_type
                 FROM chain JOIN s ON s.user_id = chain.user_id AND s.n = chain.n + 1 WHERE s.n <= 5)
       SELECT user_id, max(n) AS steps, arg_max(path, n) AS path FROM chain GROUP BY 1""",
)
def recursive_chain(t: Tables):
    return windows.first_steps(
        t.events, ["user_id"], [F.col("ts"), F.col("event_id")], "event_type", 5
    )


@query(
    "linked_rows",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
         (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 450000)""",
)
def linked_rows(t: Tables):
    seed = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 450000)
    return joins.linked_rows(t.orders, seed, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    "transfer_after_admission",
    """SELECT o.o_custkey, first_date, o_orderkey, o_orderdate FROM orders o
       JOIN (SELECT o_custkey, min(o_orderdate) AS first_date FROM orders GROUP BY 1) f
         ON o.o_custkey = f.o_custkey WHERE o_orderdate > first_date""",
)
def transfer_after_admission(t: Tables):
    return joins.rows_after_first(
        t.orders, t.orders, ["o_custkey"], "o_orderdate", "first_date"
    ).select("o_custkey", "first_date", "o_orderkey", "o_orderdate")


@query(
    "agg_count",
    """SELECT o_orderpriority, count(*) AS n, count(nullif(o_orderstatus, 'P')) AS n_status
       FROM orders GROUP BY 1""",
)
def agg_count(t: Tables):
    return t.orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("n_status"),
    )


@query(
    "agg_count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY 1",
)
def agg_count_distinct(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        aggregates.distinct_count("l_orderkey").alias("n_orders")
    )


@query(
    "agg_basic",
    f"""SELECT l_returnflag, {rounded("sum(l_quantity)", 2)} AS total,
               {rounded("avg(l_extendedprice)", 4)} AS mean_price,
               min(l_discount) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1""",
)
def agg_basic(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        numbers.round_half_up(F.sum("l_quantity"), 2).alias("total"),
        numbers.round_half_up(F.avg("l_extendedprice"), 4).alias("mean_price"),
        F.min("l_discount").alias("low"),
        F.max("l_extendedprice").alias("high"),
    )


@query(
    "agg_multi_key",
    """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n
       FROM lineitem GROUP BY 1, 2, 3""",
)
def agg_multi_key(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_expr_key",
    """SELECT left(p_name, 1) AS first_letter, p_size // 10 AS decade, count(*) AS n
       FROM part GROUP BY 1, 2""",
)
def agg_expr_key(t: Tables):
    return t.part.groupBy(
        F.substring("p_name", 1, 1).alias("first_letter"),
        numbers.whole_quotient(F.col("p_size"), F.lit(10)).alias("decade"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_having",
    """SELECT o_custkey, count(*) AS n, max(o_totalprice) AS high FROM orders
       GROUP BY 1 HAVING count(*) > 12 AND max(o_totalprice) > 400000""",
)
def agg_having(t: Tables):
    grouped = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("high")
    )
    return grouped.filter((F.col("n") > 12) & (F.col("high") > 400000))


@query(
    "agg_filter",
    """SELECT count(c_custkey) FILTER (c_acctbal < 0) AS debt,
              count(c_custkey) FILTER (c_acctbal >= 0 AND c_acctbal <= 5000) AS middle,
              count(c_custkey) FILTER (c_acctbal > 5000) AS rich FROM customer""",
)
def agg_filter(t: Tables):
    balance = F.col("c_acctbal")
    return t.customer.agg(
        aggregates.count_where(balance < 0).alias("debt"),
        aggregates.count_where((balance >= 0) & (balance <= 5000)).alias("middle"),
        aggregates.count_where(balance > 5000).alias("rich"),
    )


@query(
    "agg_conditional",
    f"""SELECT o_orderpriority,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished,
               count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS open,
               {rounded("100.0 * sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*)", 2)}
                 AS finished_pct FROM orders GROUP BY 1""",
)
def agg_conditional(t: Tables):
    finished = F.col("o_orderstatus") == "F"
    return t.orders.groupBy("o_orderpriority").agg(
        F.sum(F.when(finished, 1).otherwise(0)).alias("finished"),
        aggregates.count_where(F.col("o_orderstatus") == "O").alias("open"),
        aggregates.rate_where(finished).alias("finished_pct"),
    )


@query(
    "agg_cond_distinct",
    """SELECT count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers,
              count(DISTINCT CASE WHEN value > 150 THEN user_id END) AS large FROM events""",
)
def agg_cond_distinct(t: Tables):
    user = F.col("user_id")
    return t.events.agg(
        F.count_distinct(F.when(F.col("event_type") == "purchase", user)).alias("buyers"),
        F.count_distinct(F.when(F.col("value") > 150, user)).alias("large"),
    )


@query(
    "pct_of_total",
    f"""SELECT c_mktsegment, count(*) AS n,
               {rounded("count(*) * 100.0 / (SELECT count(*) FROM customer)", 2)} AS pct
        FROM customer WHERE c_acctbal > 1000 GROUP BY 1""",
)
def pct_of_total(t: Tables):
    return aggregates.share_of_total(t.customer, ["c_mktsegment"], F.col("c_acctbal") > 1000)


@query(
    "pct_of_total_window",
    f"""SELECT o_orderstatus, count(*) AS n,
               {rounded("100.0 * count(*) / sum(count(*)) OVER ()", 2)} AS pct
        FROM orders GROUP BY 1""",
)
def pct_of_total_window(t: Tables):
    return aggregates.share_of_counted(t.orders, ["o_orderstatus"])


@query(
    "group_rate",
    f"""SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_totalprice > 300000) AS hits,
               {rounded("avg(CASE WHEN o_totalprice > 300000 THEN 1.0 ELSE 0 END) * 100", 2)} AS rate
        FROM orders GROUP BY 1""",
)
def group_rate(t: Tables):
    return aggregates.group_rate(t.orders, ["o_orderpriority"], F.col("o_totalprice") > 300000)


@query(
    "safe_ratio",
    f"""SELECT user_id, {rounded('''count(*) FILTER (event_type = 'view') * 1.0
                 / nullif(count(*) FILTER (event_type = 'purchase' AND value > 100), 0)''', 4)} AS ratio
        FROM events GROUP BY 1""",
)
def safe_ratio(t: Tables):
    kind = F.col("event_type")
    ratio = aggregates.count_ratio(kind == "view", (kind == "purchase") & (F.col("value") > 100))
    return t.events.groupBy("user_id").agg(numbers.round_half_up(ratio, 4).alias("ratio"))


@query(
    "agg_corr",
    f"""WITH c AS (SELECT l_linestatus, corr(l_extendedprice, l_quantity) AS price_quantity,
                   corr(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END, l_discount) AS returned,
                   corr(epoch(l_shipdate), l_tax) AS time_tax, corr(l_linenumber, l_quantity) AS coded
                 FROM lineitem GROUP BY 1)
        SELECT l_linestatus, 'price_quantity' AS pair, {rounded("price_quantity", 6)} AS correlation FROM c
        UNION ALL SELECT l_linestatus, 'returned', {rounded("returned", 6)} FROM c
        UNION ALL SELECT l_linestatus, 'time_tax', {rounded("time_tax", 6)} FROM c
        UNION ALL SELECT l_linestatus, 'coded', {rounded("coded", 6)} FROM c
        UNION ALL SELECT l_linestatus, 'constant', NULL FROM c""",
)
def agg_corr(t: Tables):
    coded = text.digits_only(F.concat("l_returnflag", F.col("l_linenumber").cast("string")))
    found = aggregates.correlations(
        t.lineitem, ["l_linestatus"],
        {
            "price_quantity": (F.col("l_extendedprice"), F.col("l_quantity")),
            "returned": (F.when(F.col("l_returnflag") == "R", 1).otherwise(0), F.col("l_discount")),
            "time_tax": (dates.epoch_seconds(F.col("l_shipdate")), F.col("l_tax")),
            "coded": (coded.cast("int"), F.col("l_quantity")),
            "constant": (F.lit(1), F.col("l_quantity")),
        },
    )
    return found.withColumn("correlation", numbers.round_half_up(F.col("correlation"), 6))


@query(
    "agg_covar_pop",
    f"""SELECT {rounded("var_pop(l_quantity)", 4)} AS variance,
               {rounded("covar_pop(l_quantity, l_discount)", 6)} AS covariance,
               {rounded("corr(l_quantity, l_discount)", 6)} AS correlation FROM lineitem""",
)
def agg_covar_pop(t: Tables):
    quantity, discount = F.col("l_quantity"), F.col("l_discount")
    return t.lineitem.agg(
        numbers.round_half_up(F.var_pop(quantity), 4).alias("variance"),
        numbers.round_half_up(F.covar_pop(quantity, discount), 6).alias("covariance"),
        numbers.round_half_up(aggregates.correlation(quantity, discount), 6).alias("correlation"),
    )


@query(
    "agg_dispersion",
    f"""SELECT l_returnflag, {rounded("var_samp(l_quantity)", 4)} AS variance,
               {rounded("stddev_samp(l_quantity)", 4)} AS deviation,
               {rounded("var_samp(l_quantity) / avg(l_quantity)", 4)} AS dispersion,
               {rounded("stddev_samp(l_quantity) / avg(l_quantity)", 4)} AS variation
        FROM lineitem GROUP BY 1""",
)
def agg_dispersion(t: Tables):
    quantity = F.col("l_quantity")
    return t.lineitem.groupBy("l_returnflag").agg(
        numbers.round_half_up(F.var_samp(quantity), 4).alias("variance"),
        numbers.round_half_up(F.stddev_samp(quantity), 4).alias("deviation"),
        numbers.round_half_up(aggregates.dispersion_index(quantity), 4).alias("dispersion"),
        numbers.round_half_up(aggregates.variation(quantity), 4).alias("variation"),
    )


@query(
    "sigma_outliers",
    """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events)
       SELECT event_id, user_id, value FROM events, s WHERE value > m + 2 * d OR value < m - 2 * d""",
)
def sigma_outliers(t: Tables):
    return filters.sigma_outliers(t.events.select("event_id", "user_id", "value"), "value", 2)


@query(
    "agg_percentile",
    f"""SELECT event_type, {rounded("quantile_cont(value, 0.5)", 6)} AS median,
               {rounded("quantile_cont(value, 0.99)", 6)} AS p99 FROM events GROUP BY 1""",
)
def agg_percentile(t: Tables):
    found = percentiles.percentiles(
        t.events, ["event_type"], "value", {"median": 0.5, "p99": 0.99}
    )
    return found.select(
        "event_type", numbers.round_half_up(F.col("median"), 6).alias("median"),
        numbers.round_half_up(F.col("p99"), 6).alias("p99"),
    )


@query(
    "above_percentile",
    """SELECT event_id, e.event_type, value FROM events e JOIN
         (SELECT event_type, quantile_cont(value, 0.99) AS p FROM events GROUP BY 1) q
         ON e.event_type = q.event_type WHERE value >= p""",
)
def above_percentile(t: Tables):
    limit = percentiles.percentiles(t.events, ["event_type"], "value", {"p": 0.99})
    joined = t.events.join(limit, "event_type").filter(F.col("value") >= F.col("p"))
    return joined.select("event_id", "event_type", "value")


@query(
    "period_percentiles",
    """SELECT o_orderpriority, count(o_totalprice) AS n, quantile_disc(o_totalprice, 0.25) AS q1,
              quantile_disc(o_totalprice, 0.5) AS median, quantile_disc(o_totalprice, 0.75) AS q3
       FROM orders WHERE year(o_orderdate) = 1995 GROUP BY 1""",
)
def period_percentiles(t: Tables):
    """A year's quartiles from twelve stored sketches a group; exact up to 4096 values a group."""
    by_month = stage(
        sketches.period_sketches(t.orders, ["o_orderpriority"], "o_orderdate", "o_totalprice"), "sketches"
    )
    of_year = by_month.filter(F.year("period") == 1995)
    return sketches.merged_percentiles(of_year, ["o_orderpriority"], {"q1": 0.25, "median": 0.5, "q3": 0.75})


@query(
    "set_counts",
    """WITH c AS (SELECT o_orderstatus, o_custkey, bool_or(o_orderpriority = '1-URGENT') AS a,
                         bool_or(o_orderpriority = '5-LOW') AS b
                  FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1, 2)
       SELECT o_orderstatus, count(*) FILTER (a) AS urgent, count(*) FILTER (b) AS low,
              count(*) FILTER (a AND b) AS urgent_and_low, count(*) FILTER (a AND NOT b) AS only_urgent,
              count(*) FILTER (a OR b) AS urgent_or_low FROM c GROUP BY 1""",
)
def set_counts(t: Tables):
    """Customers in one set and not in another, from one scan; exact up to 65,536 a set."""
    priority = F.col("o_orderpriority")
    found = sketches.set_sketches(
        t.orders, ["o_orderstatus"], "o_custkey", {"a": priority == "1-URGENT", "b": priority == "5-LOW"}
    )
    a, b = F.col("a"), F.col("b")
    return found.select(
        "o_orderstatus",
        sketches.members(a).alias("urgent"),
        sketches.members(b).alias("low"),
        sketches.members(sketches.both(a, b)).alias("urgent_and_low"),
        sketches.members(sketches.only(a, b)).alias("only_urgent"),
        sketches.members(sketches.either(a, b)).alias("urgent_or_low"),
    )


@query(
    "agg_mode",
    """SELECT l_returnflag, mode() WITHIN GROUP (ORDER BY l_quantity) AS mode
       FROM lineitem GROUP BY 1""",
)
def agg_mode(t: Tables):
    return aggregates.mode_value(t.lineitem, ["l_returnflag"], "l_quantity")


QUANTITY_BANDS = [(None, 10, 0), (10, 25, 1), (25, 40, 2), (40, None, 3)]
DISCOUNT_BANDS = [(0.02, 0.05, 1), (0.05, 0.08, 2), (0.08, None, 3)]
PRICE_BANDS = [(20000, 50000, 1), (50000, None, 3)]


@query(
    "score_bands",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 25 THEN 1
                   WHEN l_quantity < 40 THEN 2 ELSE 3 END
            + CASE WHEN l_discount >= 0.08 THEN 3 WHEN l_discount >= 0.05 THEN 2
                   WHEN l_discount >= 0.02 THEN 1 ELSE 0 END
            + CASE WHEN l_extendedprice >= 50000 THEN 3 WHEN l_extendedprice >= 20000 THEN 1 ELSE 0 END
              AS score FROM lineitem""",
)
def score_bands(t: Tables):
    score = (
        numbers.score(F.col("l_quantity"), QUANTITY_BANDS)
        + numbers.score(F.col("l_discount"), DISCOUNT_BANDS)
        + numbers.score(F.col("l_extendedprice"), PRICE_BANDS)
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", score.alias("score")
    )


@query(
    "flag_sum",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END, 0)
            + coalesce(CASE WHEN o_totalprice > 250000 THEN 1 END, 0)
            + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS flags FROM orders""",
)
def flag_sum(t: Tables):
    finished = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    large = F.when(F.col("o_totalprice") > 250000, 1)
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1)
    return t.orders.select("o_orderkey", numbers.flag_sum(finished, large, urgent).alias("flags"))


@query(
    "agg_skewness",
    f"""SELECT {rounded("avg(o_totalprice)", 4)} AS mean,
               {rounded("quantile_cont(o_totalprice, 0.5)", 4)} AS median,
               {rounded("stddev_samp(o_totalprice)", 4)} AS sd,
               {rounded("3 * (avg(o_totalprice) - quantile_cont(o_totalprice, 0.5)) / stddev_samp(o_totalprice)", 6)}
                 AS skew FROM orders""",
)
def agg_skewness(t: Tables):
    found = aggregates.skewness(t.orders, "o_totalprice")
    return found.select(
        *[numbers.round_half_up(F.col(c), 4).alias(c) for c in ("mean", "median", "sd")],
        numbers.round_half_up(F.col("skew"), 6).alias("skew"),
    )


@query(
    "agg_array",
    """SELECT c_mktsegment, (n - 1) // 1000000 AS part,
              CAST(to_json(array_agg(c_custkey ORDER BY c_custkey)) AS VARCHAR) AS ids
       FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n
             FROM customer) GROUP BY 1, 2""",
)
def agg_array(t: Tables):
    arrays = aggregates.group_arrays(t.customer, ["c_mktsegment"], "c_custkey", "ids")
    return arrays.select("c_mktsegment", "part", F.to_json("ids").alias("ids"))


@query(
    "pivot_crosstab",
    """SELECT o_orderstatus, nullif(count(*) FILTER (o_orderpriority = '1-URGENT'), 0) AS urgent,
              nullif(count(*) FILTER (o_orderpriority = '3-MEDIUM'), 0) AS medium,
              nullif(count(*) FILTER (o_orderpriority = '9-NEVER'), 0) AS never
       FROM orders GROUP BY 1""",
)
def pivot_crosstab(t: Tables):
    names = {"1-URGENT": "urgent", "3-MEDIUM": "medium", "9-NEVER": "never"}
    return crosstabs.crosstab(t.orders, ["o_orderstatus"], "o_orderpriority", names)


@query(
    "crosstab_measures",
    """SELECT 'discounted' AS measure,
              CAST(sum(CASE WHEN l_discount > 0.05 AND l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS f,
              CAST(sum(CASE WHEN l_discount > 0.05 AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS o
       FROM lineitem
       UNION ALL
       SELECT 'large', CAST(sum(CASE WHEN l_quantity > 40 AND l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT),
              CAST(sum(CASE WHEN l_quantity > 40 AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT)
       FROM lineitem
       UNION ALL
       SELECT 'returned', CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT),
              CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT)
       FROM lineitem""",
)
def crosstab_measures(t: Tables):
    measures = {
        "discounted": F.col("l_discount") > 0.05,
        "large": F.col("l_quantity") > 40,
        "returned": F.col("l_returnflag") == "R",
    }
    return crosstabs.measures_by_category(
        t.lineitem, measures, "l_linestatus", {"F": "f", "O": "o"}
    )


@query(
    "unpivot_sum",
    f"""SELECT l_suppkey, kind, {rounded("sum(v)", 2)} AS total FROM (
          SELECT l_suppkey, l_quantity AS v, 'quantity' AS kind FROM lineitem
          UNION ALL SELECT l_suppkey, l_discount, 'discount' FROM lineitem
          UNION ALL SELECT l_suppkey, l_tax, 'tax' FROM lineitem) GROUP BY 1, 2""",
)
def unpivot_sum(t: Tables):
    columns = {"l_quantity": "quantity", "l_discount": "discount", "l_tax": "tax"}
    sums = crosstabs.unpivot_sum(t.lineitem, ["l_suppkey"], columns)
    return sums.withColumn("total", numbers.round_half_up(F.col("total"), 2))


@query(
    "band_histogram",
    """SELECT CAST(floor(c_acctbal / 1000) AS BIGINT) AS band, count(*) AS n
       FROM customer GROUP BY 1""",
)
def band_histogram(t: Tables):
    return crosstabs.band_counts(t.customer, numbers.band(F.col("c_acctbal"), 1000))


@query(
    "avg_duration",
    f"""SELECT l_returnflag, {rounded("avg(epoch(l_shipdate) - epoch(o_orderdate)) / 3600", 4)} AS hours
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def avg_duration(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    hours = F.avg(dates.hours_between(F.col("o_orderdate"), F.col("l_shipdate")))
    return joined.groupBy("l_returnflag").agg(numbers.round_half_up(hours, 4).alias("hours"))


@query(
    "date_span",
    """SELECT o_custkey, CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS BIGINT) AS days
       FROM orders GROUP BY 1""",
)
def date_span(t: Tables):
    span = dates.calendar_days_between(F.min("o_orderdate"), F.max("o_orderdate"))
    return t.orders.groupBy("o_custkey").agg(span.alias("days"))


@query(
    "text_bar",
    """SELECT rpad(o_orderpriority, 16, ' ') AS priority, count(*) AS n,
              repeat('▰', CAST(count(*) * 40 // max(count(*)) OVER () AS INT)) AS bar
       FROM orders GROUP BY o_orderpriority HAVING count(*) > 100""",
)
def text_bar(t: Tables):
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 100).select(
        F.rpad("o_orderpriority", 16, " ").alias("priority"), "n",
        text.text_bar(F.col("n"), F.max("n").over(Window.partitionBy()), 40).alias("bar"),
    )


@query(
    "most_frequent",
    """SELECT dayname(o_orderdate) AS weekday, count(*) AS n FROM orders
       GROUP BY 1 ORDER BY n DESC, weekday LIMIT 1""",
)
def most_frequent(t: Tables):
    days = t.orders.select(dates.weekday_name(F.col("o_orderdate")).alias("weekday"))
    return ranking.most_frequent(days, [], "weekday")


@query(
    "most_frequent_per_group",
    """SELECT o_orderstatus, o_orderpriority, n FROM (
         SELECT o_orderstatus, o_orderpriority, count(*) AS n,
                row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, o_orderpriority) AS r
         FROM orders GROUP BY 1, 2) WHERE r = 1""",
)
def most_frequent_per_group(t: Tables):
    return ranking.most_frequent(t.orders, ["o_orderstatus"], "o_orderpriority")


@query(
    "least_frequent",
    """SELECT hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1 ORDER BY n, hour LIMIT 1""",
)
def least_frequent(t: Tables):
    hours = t.events.select(F.hour("ts").alias("hour"))
    return ranking.most_frequent(hours, [], "hour", least=True)


@query(
    "entity_summary",
    f"""SELECT c_custkey, {rounded("mean_price", 4)} AS mean_price, coalesce(n_orders, 0) AS n_orders,
               {rounded("mean_value", 4)} AS mean_value, high_value, coalesce(n_events, 0) AS n_events
        FROM customer
        LEFT JOIN (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*)
                            AS mean_price, count(*) AS n_orders
                   FROM orders GROUP BY 1) ON o_custkey = c_custkey
        LEFT JOIN (SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_value, max(value) AS high_value,
                          count(*) AS n_events FROM events GROUP BY 1) ON user_id = c_custkey""",
)
def entity_summary(t: Tables):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    events = t.events.withColumnRenamed("user_id", "c_custkey")
    return aggregates.entity_summary(
        t.customer.select("c_custkey"),
        ["c_custkey"],
        [
            (orders, {
                "mean_price": aggregates.exact_mean(F.col("o_totalprice"), 4, scale=6),
                "n_orders": F.count(F.lit(1)),
            }),
            (events, {
                "mean_value": aggregates.exact_mean(F.col("value"), 4, scale=6),
                "high_value": F.max("value"),
                "n_events": F.count(F.lit(1)),
            }),
        ],
        zero_when_missing=["n_orders", "n_events"],
    )


@query(
    "season_counts",
    """WITH x AS (SELECT 1 AS s, month(o_orderdate) AS m FROM orders
                  UNION ALL SELECT 2, month(l_shipdate) FROM lineitem
                  UNION ALL SELECT 3, month(ts) FROM events)
       SELECT CASE WHEN m IN (12, 1, 2) THEN 'Winter' WHEN m IN (3, 4, 5) THEN 'Spring'
                   WHEN m IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
              count(*) FILTER (s = 1) AS orders, count(*) FILTER (s = 2) AS shipments,
              count(*) FILTER (s = 3) AS events FROM x GROUP BY 1""",
)
def season_counts(t: Tables):
    return crosstabs.side_by_side(
        {
            "orders": (t.orders, dates.season(F.col("o_orderdate"))),
            "shipments": (t.lineitem, dates.season(F.col("l_shipdate"))),
            "events": (t.events, dates.season(F.col("ts"))),
        },
        "season",
    )


@query(
    "agg_of_qualified",
    """SELECT max(o_totalprice) AS high, count(*) AS n FROM orders WHERE o_custkey IN
         (SELECT o_custkey FROM orders GROUP BY 1 HAVING avg(o_totalprice) < 200000)""",
)
def agg_of_qualified(t: Tables):
    return aggregates.of_qualified(
        t.orders, ["o_custkey"], F.avg("o_totalprice") < 200000,
        {"high": F.max("o_totalprice"), "n": F.count(F.lit(1))},
    )


@query(
    "median_by_rank",
    f"""SELECT event_type, {rounded("median(value)", 6)} AS median FROM events GROUP BY 1""",
)
def median_by_rank(t: Tables):
    found = percentiles.median_by_rank(t.events, ["event_type"], "value", "event_id")
    return found.withColumn("median", numbers.round_half_up(F.col("median"), 6))


@query(
    "set_union",
    """SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9000
       UNION SELECT s_nationkey FROM supplier WHERE s_acctbal < 1000""",
)
def set_union(t: Tables):
    return setops.union_distinct(
        t.customer.filter(F.col("c_acctbal") > 9000).select(F.col("c_nationkey").alias("nationkey")),
        t.supplier.filter(F.col("s_acctbal") < 1000).select(F.col("s_nationkey").alias("nationkey")),
    )


@query(
    "set_union_all",
    """SELECT c_nationkey AS nationkey, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""",
)
def set_union_all(t: Tables):
    return setops.union_all(
        t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance")),
        t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance")),
    )


@query(
    "set_intersect",
    """SELECT user_id FROM events WHERE event_type = 'view' AND value > 60
       INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 60""",
)
def set_intersect(t: Tables):
    large = t.events.filter(F.col("value") > 60)
    return setops.intersect(
        large.filter(F.col("event_type") == "view").select("user_id"),
        large.filter(F.col("event_type") == "purchase").select("user_id"),
    )


@query(
    "set_except",
    """SELECT c_custkey, c_name FROM customer JOIN (
         SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
         EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ON c_custkey = o_custkey""",
)
def set_except(t: Tables):
    finished = t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey")
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    only = setops.minus(finished, urgent)
    return only.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name"
    )
