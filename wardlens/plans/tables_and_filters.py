"""Scans, table changes, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlens.functions import dates, numbers
from wardlens.operators import filters, ranking
from wardlens.plans.registry import Tables, query
from wardlens.sources import inline, maintenance
from wardlens.sources.staging import save_table, staging_path
from wardlens.sources.tables import as_view
from wardlens.sources.versions import open_table, replace_table
from wardlens.streaming import rules


@query("scan_table", "SELECT * FROM nation")
def scan_table(t: Tables):
    return t.nation


PRIORITY_WEIGHTS = [
    ("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1),
]


@query(
    "inline_values_join",
    """SELECT o_orderkey, weight FROM orders
       JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3),
                    ('4-NOT SPECIFIED', 2), ('5-LOW', 1)) v(priority, weight)
         ON o_orderpriority = priority""",
)
def inline_values_join(t: Tables):
    weights = inline.inline_rows(t.spark, PRIORITY_WEIGHTS, "priority string, weight int")
    joined = t.orders.join(F.broadcast(weights), F.col("o_orderpriority") == F.col("priority"))
    return joined.select("o_orderkey", "weight")


@query(
    "series_expand",
    """SELECT l_returnflag, l_linestatus, count(*) AS units, CAST(sum(unit) AS BIGINT) AS unit_sum
       FROM (SELECT l_returnflag, l_linestatus,
                    unnest(generate_series(l_linenumber, CAST(l_quantity AS BIGINT) - 10, 2)) AS unit
             FROM lineitem) GROUP BY 1, 2""",
)
def series_expand(t: Tables):
    lines = t.lineitem.select(
        "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("int").alias("first"),
        (F.col("l_quantity").cast("int") - 10).alias("last"),
    )
    units = inline.expand_series(lines, F.col("first"), F.col("last"), F.lit(2), "unit")
    return units.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("unit").alias("units"), F.sum("unit").alias("unit_sum")
    )


@query(
    "ctas_roundtrip",
    """SELECT c_custkey, c_name, n_name, c_acctbal FROM customer
       JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 5000""",
)
def ctas_roundtrip(t: Tables):
    rich = (
        t.customer.filter(F.col("c_acctbal") > 5000)
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "n_name", "c_acctbal")
    )
    return save_table(rich, staging_path(t.spark, "rich_customers"))


@query(
    "table_replaced",
    """SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_acctbal > 0""",
)
def table_replaced(t: Tables):
    """A table loaded and then replaced by a query over its own rows; the new version is read back."""
    root = staging_path(t.spark, "accounts")
    replace_table(t.customer.select("c_custkey", "c_name", "c_acctbal"), root)
    before = open_table(t.spark, root)
    replace_table(before.filter("c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") + 100), root)
    return open_table(t.spark, root)


@query(
    "view_query",
    """SELECT c_custkey, c_mktsegment, o_orderkey, o_totalprice
       FROM customer JOIN orders ON c_custkey = o_custkey
       WHERE o_orderstatus = 'F' AND o_totalprice > 300000""",
)
def view_query(t: Tables):
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    view = as_view(
        joined.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)),
        "large_finished_orders",
    )
    return view.select("c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice")


@query(
    "check_split",
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P') = 'F', false) AS accepted
       FROM orders""",
)
def check_split(t: Tables):
    rule = F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F"
    accepted, rejected = maintenance.check_split(t.orders.select("o_orderkey", "o_orderstatus"), rule)
    tagged = accepted.withColumn("accepted", F.lit(True)).unionByName(
        rejected.withColumn("accepted", F.lit(False))
    )
    return tagged.select("o_orderkey", "accepted")


@query(
    "append_rows",
    """SELECT n_nationkey, n_name, n_regionkey FROM nation
       UNION ALL SELECT 100, 'NEWLAND', NULL UNION ALL SELECT 101, 'OLDLAND', NULL""",
)
def append_rows(t: Tables):
    rows = inline.inline_rows(
        t.spark, [(100, "NEWLAND"), (101, "OLDLAND")], "n_nationkey int, n_name string"
    )
    return maintenance.append_rows(t.nation, rows)


@query(
    "inherit_scan",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey,
              NULL AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
)
def inherit_scan(t: Tables):
    parent = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
    )
    child = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance"),
    )
    return maintenance.family_scan(parent, child)


@query(
    "add_column",
    """SELECT c_custkey, 'checked' AS state, c_acctbal * 2 AS doubled,
              CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 5000 THEN 1 ELSE 2 END AS tier
       FROM customer""",
)
def add_column(t: Tables):
    balance = F.col("c_acctbal")
    out = maintenance.add_columns(
        t.customer,
        state=F.lit("checked"),
        doubled=balance * 2,
        tier=F.when(balance < 0, 0).when(balance < 5000, 1).otherwise(2),
    )
    return out.select("c_custkey", "state", "doubled", "tier")


@query(
    "update_from_join",
    """SELECT o_orderkey, CASE WHEN c.c_custkey IS NULL THEN o_orderpriority
                               ELSE c_mktsegment END AS o_orderpriority
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal < 0) c
         ON o_custkey = c.c_custkey""",
)
def update_from_join(t: Tables):
    debtors = t.customer.filter(F.col("c_acctbal") < 0).withColumnRenamed("c_custkey", "o_custkey")
    updated = maintenance.update_from(
        t.orders, debtors, ["o_custkey"], "o_orderpriority", F.col("c_mktsegment"),
        [F.col("c_name")],
    )
    return updated.select("o_orderkey", "o_orderpriority")


@query(
    "alert_rule",
    """SELECT event_id, user_id, value, 'value above 100' AS alert
       FROM events WHERE value > 100""",
)
def alert_rule(t: Tables):
    alerts = rules.stream_alerts(
        t.spark, f"{t.folder}/events.parque[t]", t.events.schema,
        F.col("value") > 100, "value above 100", staging_path(t.spark, "alerts"),
    )
    return alerts.select("event_id", "user_id", "value", "alert")


@query("update_returning", "SELECT n_nationkey, lower(n_name) AS n_name, n_regionkey FROM nation")
def update_returning(t: Tables):
    return maintenance.add_columns(t.nation, n_name=F.lower("n_name"))


@query("drop_column", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def drop_column(t: Tables):
    return maintenance.drop_columns(t.customer, "c_acctbal")


@query(
    "surrogate_key",
    "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name, c_custkey) AS sno FROM customer",
)
def surrogate_key(t: Tables):
    return ranking.surrogate_key(
        t.customer.select("c_custkey", "c_name"), ["c_name", "c_custkey"], "sno"
    )


@query("project_alias", "SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer")
def project_alias(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )


@query("distinct_values", "SELECT DISTINCT p_name, p_type FROM part")
def distinct_values(t: Tables):
    return t.part.select("p_name", "p_type").distinct()


@query(
    "filter_compare",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
       WHERE l_quantity >= 45 AND l_returnflag <> 'N'""",
)
def filter_compare(t: Tables):
    return t.lineitem.filter((F.col("l_quantity") >= 45) & (F.col("l_returnflag") != "N")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


@query(
    "filter_bool",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       WHERE (l_returnflag = 'R' OR l_linestatus = 'O') AND (l_discount > 0.08 OR l_tax = 0)""",
)
def filter_bool(t: Tables):
    flags = (F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "O")
    money = (F.col("l_discount") > 0.08) | (F.col("l_tax") == 0)
    return t.lineitem.filter(flags & money).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    "filter_between",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 120000",
)
def filter_between(t: Tables):
    return t.orders.filter(F.col("o_totalprice").between(100000, 120000)).select(
        "o_orderkey", "o_totalprice"
    )


@query("filter_in", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup')")
def filter_in(t: Tables):
    return t.events.filter(F.col("event_type").isin("error", "signup")).select(
        "event_id", "event_type"
    )


@query(
    "filter_null",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders
       WHERE nullif(o_orderstatus, 'P') IS NULL AND nullif(o_orderpriority, '5-LOW') IS NOT NULL""",
)
def filter_null(t: Tables):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return t.orders.filter(status.isNull() & priority.isNotNull()).select(
        "o_orderkey", status.alias("status")
    )


@query(
    "filter_like",
    """SELECT DISTINCT p_name FROM part
       WHERE p_name LIKE 'b%' AND p_name LIKE '%o%' OR p_name LIKE 'red' || '%'""",
)
def filter_like(t: Tables):
    name = F.col("p_name")
    wanted = (name.startswith("b") & name.contains("o")) | name.startswith("red")
    return t.part.filter(wanted).select("p_name").distinct()


@query(
    "filter_regex",
    """SELECT p_partkey, p_name, regexp_matches(p_name, 'et$') AS ends_et FROM part
       WHERE regexp_matches(p_name, '(?i)(RING|GEAR)') OR regexp_matches(p_name, 'et$')""",
)
def filter_regex(t: Tables):
    ends = F.col("p_name").rlike("et$")
    return t.part.filter(F.col("p_name").rlike("(?i)(RING|GEAR)") | ends).select(
        "p_partkey", "p_name", ends.alias("ends_et")
    )


@query(
    "filter_date_range",
    """SELECT o_orderkey FROM orders
       WHERE CAST(o_orderdate AS DATE) >= DATE '1996-02-01'
         AND CAST(o_orderdate AS DATE) < DATE '1996-03-01'""",
)
def filter_date_range(t: Tables):
    return t.orders.filter(
        filters.date_range("o_orderdate", "1996-02-01", "1996-03-01")
    ).select("o_orderkey")


@query(
    "filter_date_part",
    """SELECT o_orderkey FROM orders
       WHERE extract(year FROM o_orderdate) = 1997 AND extract(month FROM o_orderdate) = 12""",
)
def filter_date_part(t: Tables):
    # The year as a range on the raw column is pushed to the scan; the month then filters the rest.
    return t.orders.filter(
        filters.year_is("o_orderdate", 1997) & (F.month("o_orderdate") == 12)
    ).select("o_orderkey")


@query(
    "filter_time_of_day",
    """SELECT event_id, ts FROM events
       WHERE CAST(ts AS TIME) BETWEEN TIME '04:00:00' AND TIME '05:00:00'""",
)
def filter_time_of_day(t: Tables):
    return t.events.filter(dates.within_time_of_day(F.col("ts"), "04:00:00", "05:00:00")).select(
        "event_id", "ts"
    )


@query(
    "case_label",
    """SELECT c_custkey, CASE WHEN nullif(c_nationkey, 3) < 5 THEN 'low'
                              WHEN nullif(c_nationkey, 3) < 15 THEN 'middle' ELSE 'other' END AS label,
              CASE WHEN c_acctbal < 0 THEN 'debt' END AS debt
       FROM customer""",
)
def case_label(t: Tables):
    nation = F.nullif(F.col("c_nationkey"), F.lit(3))
    return t.customer.select(
        "c_custkey",
        F.when(nation < 5, "low").when(nation < 15, "middle").otherwise("other").alias("label"),
        F.when(F.col("c_acctbal") < 0, "debt").alias("debt"),
    )


@query(
    "bool_column",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              l_returnflag = 'A' AS returned, l_discount > l_tax AS cheap FROM lineitem""",
)
def bool_column(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_returnflag") == "A").alias("returned"),
        (F.col("l_discount") > F.col("l_tax")).alias("cheap"),
    )


@query(
    "parity",
    """SELECT c_custkey, CASE WHEN nullif(c_nationkey, 7) IS NULL THEN 'Null'
                              WHEN nullif(c_nationkey, 7) % 2 = 0 THEN 'Even' ELSE 'Odd' END AS parity
       FROM customer""",
)
def parity(t: Tables):
    nation = F.nullif(F.col("c_nationkey"), F.lit(7))
    return t.customer.select("c_custkey", numbers.parity_label(nation).alias("parity"))


@query(
    "range_violation",
    """WITH lab AS (
         SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                CASE WHEN l_quantity = 1 THEN '<5' WHEN l_quantity = 2 THEN '1.2.3'
                     WHEN l_quantity = 3 THEN ''
                     ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS labvalue,
                CASE WHEN l_linenumber % 3 = 0 THEN 'none'
                     ELSE CAST(l_linenumber AS VARCHAR)
                          || CASE WHEN l_linenumber % 2 = 0 THEN '--' ELSE '～' END
                          || CAST(30 + l_linenumber AS VARCHAR) || '.5' END AS reference
         FROM lineitem), parts AS (
         SELECT *, split_part(reference, '--', 1) AS low, split_part(reference, '--', 2) AS high
         FROM lab WHERE reference LIKE '%--%'
         UNION ALL
         SELECT *, split_part(reference, '～', 1), split_part(reference, '～', 2)
         FROM lab WHERE reference LIKE '%～%')
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, labvalue, reference FROM parts
       WHERE TRY_CAST(labvalue AS DOUBLE) < TRY_CAST(low AS DOUBLE)
          OR TRY_CAST(labvalue AS DOUBLE) > TRY_CAST(high AS DOUBLE)""",
)
def range_violation(t: Tables):
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    value = (
        F.when(quantity == 1, "<5").when(quantity == 2, "1.2.3").when(quantity == 3, "")
        .otherwise(quantity.cast("int").cast("string"))
    )
    dash = F.when(line % 2 == 0, "--").otherwise("～")
    limits = F.concat(line.cast("string"), dash, (line + 30).cast("string"), F.lit(".5"))
    lab = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", value.alias("labvalue"),
        F.when(line % 3 == 0, "none").otherwise(limits).alias("reference"),
    )
    return numbers.outside_range(lab, F.col("labvalue"), F.col("reference"), ["--", "～"])


@query(
    "scalar_subquery",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)""",
)
def scalar_subquery(t: Tables):
    return filters.equals_extreme(t.orders, "o_totalprice").select("o_orderkey", "o_totalprice")


@query(
    "semi_in",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
         (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IN
            (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_discount > 0.09))""",
)
def semi_in(t: Tables):
    lines = t.lineitem.filter((F.col("l_quantity") == 50) & (F.col("l_discount") > 0.09))
    orders = filters.within_keys(
        t.orders.filter(F.col("o_orderstatus") == "F"),
        lines.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"],
    )
    return filters.within_keys(
        t.customer, orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]
    ).select("c_custkey", "c_name")


@query(
    "anti_not_in",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
         (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def anti_not_in(t: Tables):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return filters.without_keys(
        t.customer, urgent.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]
    ).select("c_custkey", "c_name")


@query(
    "tuple_in",
    """WITH n AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
       SELECT * FROM n WHERE (o_orderstatus, n) IN
         (SELECT (o_orderstatus, max(n)) FROM n GROUP BY o_orderstatus)""",
)
def tuple_in(t: Tables):
    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("o_orderstatus").agg(F.max("n").alias("n"))
    return filters.within_keys(counts, largest, ["o_orderstatus", "n"]).select(
        "o_orderstatus", "o_orderpriority", "n"
    )


@query(
    "exists_flag",
    """SELECT k AS c_custkey, EXISTS (SELECT 1 FROM customer WHERE c_custkey = k) AS found
       FROM (VALUES (0), (7), (42), (149), (-1), (1000000000)) v(k)""",
)
def exists_flag(t: Tables):
    asked = inline.inline_rows(
        t.spark, [(k,) for k in (0, 7, 42, 149, -1, 1000000000)], "c_custkey bigint"
    )
    return filters.exists_flag(asked, t.customer, ["c_custkey"])
