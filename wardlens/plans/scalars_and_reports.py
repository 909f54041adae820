"""Scalar functions and set-based forms of the stored routines."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlens.functions import dates, numbers, text
from wardlens.operators import aggregates, ranking, reports
from wardlens.plans.registry import Tables, query, rounded
from wardlens.sources import inline


@query(
    "str_substr",
    "SELECT c_custkey, substr(c_name, 1, 2) AS two, left(c_mktsegment, 4) AS four FROM customer",
)
def str_substr(t: Tables):
    return t.customer.select(
        "c_custkey", F.substring("c_name", 1, 2).alias("two"),
        F.left("c_mktsegment", F.lit(4)).alias("four"),
    )


@query(
    "str_concat",
    """SELECT c_custkey, concat(nullif(c_mktsegment, 'BUILDING'), '/', c_nationkey) AS skipping,
              nullif(c_mktsegment, 'BUILDING') || '/' || c_nationkey AS strict,
              coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA') || ' ; ' || c_custkey AS filled
       FROM customer""",
)
def str_concat(t: Tables):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    nation = F.col("c_nationkey").cast("string")
    return t.customer.select(
        "c_custkey",
        text.concat_skip_null(segment, F.lit("/"), nation).alias("skipping"),
        F.concat(segment, F.lit("/"), nation).alias("strict"),
        F.concat_ws(" ; ", F.coalesce(segment, F.lit("NA")), F.col("c_custkey").cast("string")).alias("filled"),
    )


@query(
    "str_split_part",
    "SELECT DISTINCT p_name, split_part(p_name, ' ', 2) AS second FROM part",
)
def str_split_part(t: Tables):
    names = t.part.select("p_name").distinct()
    return names.select("p_name", text.nth_part(F.col("p_name"), " ", 2).alias("second"))


@query(
    "palindromes",
    """SELECT DISTINCT word, word = reverse(word) AS palindrome FROM
         (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}]+')) AS word FROM documents)""",
)
def palindromes(t: Tables):
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))
    found = t.documents.select(F.explode(words).alias("word")).distinct()
    return found.withColumn("palindrome", text.is_palindrome(F.col("word")))


@query(
    "str_length",
    """SELECT doc_id, CAST(bit_length(text) AS BIGINT) AS bits, length(text) * 8 AS nominal_bits,
              length(text) AS chars FROM documents""",
)
def str_length(t: Tables):
    bits, nominal, chars = text.bits_and_chars(F.col("text"))
    return t.documents.select(
        "doc_id", bits.alias("bits"), nominal.alias("nominal_bits"), chars.alias("chars")
    )


@query(
    "str_pad",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS long_key, rpad(c_mktsegment, 8, '*') AS segment,
              c_custkey FROM customer""",
)
def str_pad(t: Tables):
    return t.customer.select(
        text.zero_pad(F.col("c_custkey"), 12).alias("long_key"),
        F.rpad("c_mktsegment", 8, "*").alias("segment"), "c_custkey",
    )


@query(
    "str_case",
    "SELECT n_nationkey, lower(n_name) AS low, upper(lower(n_name)) AS high FROM nation",
)
def str_case(t: Tables):
    return t.nation.select(
        "n_nationkey", F.lower("n_name").alias("low"), F.upper(F.lower("n_name")).alias("high")
    )


@query(
    "str_position",
    """SELECT DISTINCT p_name, strpos(p_name, 'r') AS r_position, position('e' IN p_name) AS e_position
       FROM part WHERE strpos(p_name, 'r') > 0""",
)
def str_position(t: Tables):
    names = t.part.select("p_name").distinct()
    by_instr = text.position_of(F.col("p_name"), "r")
    by_position = F.position(F.lit("e"), F.col("p_name"))
    return names.filter(by_instr > 0).select(
        "p_name", by_instr.alias("r_position"), by_position.alias("e_position")
    )


@query(
    "str_regex_extract",
    """SELECT DISTINCT p_name, nullif(regexp_extract(p_name, '.{8}$'), '') AS last_eight FROM part""",
)
def str_regex_extract(t: Tables):
    names = t.part.select("p_name").distinct()
    return names.withColumn("last_eight", text.last_chars(F.col("p_name"), 8))


@query(
    "str_regex_replace",
    r"""SELECT c_custkey, CAST(regexp_replace(c_name, '\D', '', 'g') AS BIGINT) AS number FROM customer""",
)
def str_regex_replace(t: Tables):
    return t.customer.select(
        "c_custkey", text.digits_only(F.col("c_name")).cast("bigint").alias("number")
    )


@query(
    "str_relabel",
    """SELECT DISTINCT p_name, CASE WHEN p_name LIKE '%ring%' THEN 'RING' ELSE p_name END AS label
       FROM part""",
)
def str_relabel(t: Tables):
    names = t.part.select("p_name").distinct()
    return names.withColumn("label", text.relabel_if_contains(F.col("p_name"), "ring", "RING"))


@query(
    "date_parts",
    """SELECT event_id, year(ts) AS year, month(ts) AS month, hour(ts) AS hour FROM events""",
)
def date_parts(t: Tables):
    return t.events.select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.hour("ts").alias("hour")
    )


@query(
    "weekday_name",
    """SELECT o_orderkey, dayofweek(o_orderdate) AS dow, dayname(o_orderdate) AS weekday FROM orders""",
)
def weekday_name(t: Tables):
    return t.orders.select(
        "o_orderkey", dates.day_of_week(F.col("o_orderdate")).alias("dow"),
        dates.weekday_name(F.col("o_orderdate")).alias("weekday"),
    )


@query(
    "date_trunc_month",
    """SELECT o_orderkey, date_trunc('month', o_orderdate)::TIMESTAMP AS month,
              strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def date_trunc_month(t: Tables):
    return t.orders.select(
        "o_orderkey", dates.month_start(F.col("o_orderdate")).alias("month"),
        F.to_date("o_orderdate").cast("string").alias("day"),
    )


@query(
    "month_labels",
    """SELECT strftime(o_orderdate, '%Y') AS year, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS number,
              monthname(o_orderdate) AS name, count(*) AS n FROM orders GROUP BY 1, 2, 3""",
)
def month_labels(t: Tables):
    return t.orders.groupBy(
        F.date_format("o_orderdate", "yyyy").alias("year"),
        F.date_format("o_orderdate", "MM").alias("number"),
        F.date_format("o_orderdate", "MMMM").alias("name"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "duration_units",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS BIGINT) AS calendar_days,
               CAST((epoch_us(l_shipdate) - epoch_us(o_orderdate)) // 86400000000 AS BIGINT) AS whole_days,
               {rounded("(epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3600e6", 4)} AS hours,
               {rounded("(epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400e6", 6)} AS days
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def duration_units(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    start, stop = F.col("o_orderdate"), F.col("l_shipdate")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        dates.calendar_days_between(start, stop).alias("calendar_days"),
        dates.whole_days_between(start, stop).alias("whole_days"),
        numbers.round_half_up(dates.hours_between(start, stop), 4).alias("hours"),
        numbers.round_half_up(dates.days_between(start, stop), 6).alias("days"),
    )


@query(
    "birth_year",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, year(l_shipdate) - p_size AS birth_year
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def birth_year(t: Tables):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        dates.birth_year(F.col("l_shipdate"), F.col("p_size")).alias("birth_year"),
    )


@query(
    "hour_slot",
    """SELECT slot, count(*) AS n FROM (SELECT CASE
         WHEN h = 0 THEN '12AM - 1AM' WHEN h < 11 THEN h || 'AM - ' || (h + 1) || 'AM'
         WHEN h = 11 THEN '11AM - 12PM' WHEN h = 12 THEN '12PM - 1PM' WHEN h = 23 THEN '11PM - 12AM'
         ELSE (h - 12) || 'PM - ' || (h - 11) || 'PM' END AS slot FROM (SELECT hour(ts) AS h FROM events))
       GROUP BY 1""",
)
def hour_slot(t: Tables):
    hours = t.events.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return hours.select(dates.hour_slot(F.col("hour")).alias("slot"), "n")


@query(
    "math_round",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               {rounded("l_extendedprice / 7", 2)} AS rounded, CAST(ceil(l_extendedprice / 7) AS BIGINT) AS up,
               CAST(trunc(l_quantity / 7 * 100) / 100 AS DOUBLE) AS cut FROM lineitem""",
)
def math_round(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.round_half_up(F.col("l_extendedprice") / 7, 2).alias("rounded"),
        F.ceil(F.col("l_extendedprice") / 7).alias("up"),
        numbers.truncate(F.col("l_quantity") / 7, 2).alias("cut"),
    )


@query(
    "math_basic",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, pow(l_quantity, 2) AS square,
              abs(l_discount - l_tax) AS gap, l_linenumber % 3 AS rest FROM lineitem
       WHERE abs(l_discount - l_tax) > 0.03""",
)
def math_basic(t: Tables):
    gap = F.abs(F.col("l_discount") - F.col("l_tax"))
    return t.lineitem.filter(gap > 0.03).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.pow("l_quantity", F.lit(2)).alias("square"), gap.alias("gap"),
        (F.col("l_linenumber") % 3).alias("rest"),
    )


@query(
    "int_quotient",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CAST(l_quantity AS BIGINT) // l_linenumber AS quotient,
              nullif(len(generate_series(0, CAST(l_quantity AS BIGINT) - 10, l_linenumber)), 0) - 1 AS counted
       FROM lineitem""",
)
def int_quotient(t: Tables):
    whole, step = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.whole_quotient(whole, step).alias("quotient"),
        inline.series_quotient(F.lit(0), whole - 10, step).alias("counted"),
    )


@query(
    "recompute_compare",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              abs(p_retailprice * l_quantity - l_extendedprice) <= 1000 AS same
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def recompute_compare(t: Tables):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    computed = F.col("p_retailprice") * F.col("l_quantity")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.nearly_equal(computed, F.col("l_extendedprice"), 1000).alias("same"),
    )


@query(
    "safe_cast",
    """SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS number,
              TRY_CAST(c_mktsegment AS DOUBLE) AS none, CAST(c_nationkey AS VARCHAR) AS nation
       FROM customer""",
)
def safe_cast(t: Tables):
    return t.customer.select(
        "c_custkey",
        numbers.to_number(text.nth_part(F.col("c_name"), "#", 2), "bigint").alias("number"),
        numbers.to_number(F.col("c_mktsegment")).alias("none"),
        F.col("c_nationkey").cast("string").alias("nation"),
    )


@query(
    "null_handling",
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), nullif(o_orderpriority, '5-LOW'), 'none') AS first
       FROM orders""",
)
def null_handling(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.coalesce(
            F.nullif(F.col("o_orderstatus"), F.lit("P")),
            F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
            F.lit("none"),
        ).alias("first"),
    )


@query(
    "array_build",
    """SELECT c_custkey, CAST(to_json([nullif(c_mktsegment, 'BUILDING'), CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR),
              CAST(c_nationkey AS VARCHAR)]) AS VARCHAR) AS markers FROM customer""",
)
def array_build(t: Tables):
    markers = numbers.text_array(
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
        F.col("c_acctbal").cast("decimal(12,2)"), F.col("c_nationkey"),
    )
    return t.customer.select("c_custkey", F.to_json(markers).alias("markers"))


@query(
    "json_object",
    """SELECT n_nationkey, CAST(to_json({'n_nationkey': n_nationkey, 'n_name': n_name,
              'region': nullif(n_regionkey, 0)}) AS VARCHAR) AS details FROM nation""",
)
def json_object(t: Tables):
    region = F.nullif(F.col("n_regionkey"), F.lit(0)).alias("region")
    return t.nation.select(
        "n_nationkey",
        numbers.json_object(F.col("n_nationkey"), F.col("n_name"), region).alias("details"),
    )


@query("fn_age", "SELECT o_orderkey, 2024 - year(o_orderdate) AS age FROM orders")
def fn_age(t: Tables):
    return t.orders.select(
        "o_orderkey", dates.years_since(F.year("o_orderdate"), 2024).alias("age")
    )


@query(
    "fn_prefix_distinct",
    """SELECT prefix, count(DISTINCT l_orderkey) AS n FROM (VALUES ('bl'), ('blue r'), ('red'), ('zz')) v(prefix)
       LEFT JOIN (lineitem JOIN part ON l_partkey = p_partkey) ON p_name LIKE prefix || '%' GROUP BY 1""",
)
def fn_prefix_distinct(t: Tables):
    lines = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_orderkey")
    return reports.distinct_by_prefix(
        t.part, "p_name", ["bl", "blue r", "red", "zz"], "l_orderkey", facts=lines, key="p_partkey"
    )


@query(
    "fn_prefix_table",
    """SELECT prefix, count(DISTINCT l_orderkey) AS n
       FROM (SELECT DISTINCT left(p_name, k::INT) AS prefix FROM part, (VALUES (2), (5), (9)) v(k) WHERE p_partkey % 5 = 0
             UNION SELECT 'zz')
       LEFT JOIN (lineitem JOIN part ON l_partkey = p_partkey) ON starts_with(p_name, prefix) GROUP BY 1""",
)
def fn_prefix_table(t: Tables):
    names = t.part.filter(F.col("p_partkey") % 5 == 0)
    heads = F.array(*[F.left("p_name", F.lit(n)) for n in (2, 5, 9)], F.lit("zz"))
    lines = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), "l_orderkey").distinct()
    named = lines.join(t.part.select("p_partkey", "p_name"), "p_partkey")
    return reports.counts_by_prefix(named, "p_name", "l_orderkey", names.select(F.explode(heads).alias("prefix")))


@query(
    "fn_group_pct",
    f"""SELECT c_mktsegment, count(*) AS n,
               {rounded("count(*) * 100.0 / (SELECT count(*) FROM customer)", 2)} AS pct
        FROM customer GROUP BY 1""",
)
def fn_group_pct(t: Tables):
    return reports.group_percentage(t.customer, "c_mktsegment")


@query(
    "fn_entity_csv",
    """SELECT c_custkey, c_custkey || ', ' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'N/A') || ', '
              || n_name || ', ' || r_name || ', ' || coalesce(CAST(n_orders AS VARCHAR), 'N/A') || ', '
              || coalesce(CAST(n_events AS VARCHAR), 'N/A') AS details
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON o_custkey = c_custkey
       LEFT JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY 1) ON user_id = c_custkey""",
)
def fn_entity_csv(t: Tables):
    places = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_events"))
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return reports.entity_csv(
        places, [orders, events], "c_custkey",
        [F.col("c_custkey"), segment, F.col("n_name"), F.col("r_name"), F.col("n_orders"), F.col("n_events")],
    )


@query(
    "fn_last_rows",
    """SELECT o_orderpriority, o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders o
       WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders i
                                               WHERE i.o_orderpriority = o.o_orderpriority)""",
)
def fn_last_rows(t: Tables):
    orders = t.orders.select(
        "o_orderpriority", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    return ranking.rows_at_last_time(orders, ["o_orderpriority"], "month", [F.col("o_orderkey")])


@query(
    "fn_daily_avg",
    f"""SELECT d AS day, {rounded("avg(value)", 4)} AS mean
        FROM (VALUES ('2024-01-05'), ('2024-01-20'), ('2025-02-23')) v(d)
        LEFT JOIN events ON strftime(ts, '%Y-%m-%d') = d GROUP BY 1""",
)
def fn_daily_avg(t: Tables):
    means = reports.mean_of_days(t.events, "ts", "value", ["2024-01-05", "2024-01-20", "2025-02-23"])
    return means.select(
        F.col("day").cast("string").alias("day"), numbers.round_half_up(F.col("mean"), 4).alias("mean")
    )


@query(
    "fn_daily_avg_table",
    f"""SELECT strftime(d, '%Y-%m-%d') AS day, {rounded("avg(value)", 4)} AS mean
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) + INTERVAL 28 YEAR AS d FROM orders)
        LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY 1""",
)
def fn_daily_avg_table(t: Tables):
    days = t.orders.select(F.to_date(F.col("o_orderdate") + F.expr("INTERVAL 28 YEARS")).alias("day"))
    means = reports.mean_of_days(t.events, "ts", "value", days)
    return means.select(
        F.col("day").cast("string").alias("day"), numbers.round_half_up(F.col("mean"), 4).alias("mean")
    )


@query(
    "fn_filtered_pct",
    f"""SELECT coalesce({rounded("100.0 * count(*) FILTER (toxic = 1) / nullif(count(*), 0)", 2)}, 0) AS pct
        FROM labels WHERE nullif(quality, 0) IS NOT NULL""",
)
def fn_filtered_pct(t: Tables):
    counted = F.nullif(F.col("quality"), F.lit(0)).isNotNull()
    return aggregates.filtered_percent(t.labels, F.col("toxic") == 1, counted, "pct")
