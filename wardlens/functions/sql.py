"""The library's routines as session functions of Spark SQL.

They are SQL functions, which Catalyst inlines where they are called: no Python runs, and filters and
column selections reach the tables behind them.  Table functions read views or tables of the session
by the names given when they are registered.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}")


def _names(*given: str) -> None:
    for name in given:
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a plain table or column name: {name!r}")


def register_scalars(spark: SparkSession) -> list[str]:
    """Functions of their arguments alone: age_in_years, safe_ratio, share_pct, hour_slot, season_of."""
    bodies = {
        "age_in_years": ("born DATE, at DATE", "INT",
                         "CAST(floor(months_between(at, born, false) / 12) AS INT)"),
        "safe_ratio": ("part DOUBLE, whole DOUBLE", "DOUBLE", "try_divide(part, whole)"),
        "share_pct": ("part BIGINT, whole BIGINT", "DOUBLE",
                      "CAST(round(CAST(try_divide(part * 100.0BD, whole) AS DECIMAL(38, 10)), 2) AS DOUBLE)"),
        "hour_slot": ("at TIMESTAMP", "STRING",
                      "concat(date_format(at, 'ha'), ' - ', date_format(at + INTERVAL 1 HOUR, 'ha'))"),
        "season_of": ("at DATE", "STRING",
                      "CASE WHEN month(at) IN (12, 1, 2) THEN 'Winter' WHEN month(at) IN (3, 4, 5) THEN 'Spring' "
                      "WHEN month(at) IN (6, 7, 8) THEN 'Summer' WHEN at IS NOT NULL THEN 'Autumn' END"),
    }
    for name, (arguments, result, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(bodies)


def register_entity(
    spark: SparkSession, table: str, entity: str, time: str, value: str, prefix: str = ""
) -> list[str]:
    """Functions over one table of readings per entity, callable for one id, for a day or for a text's beginning.

    ``<prefix>last_rows(id)``: the rows at the entity's last time, all of them where several tie.
    ``<prefix>has_rows(id)``: whether there are any.  ``<prefix>daily_avg(day)``: mean of ``value`` on a day, NULL
    without readings.  ``<prefix>row_share(id)``: the entity's percent of all rows, NULL for an empty table.
    Called with a column, the scalar ones become joins to one aggregate of the table.
    """
    _names(table, entity, time, value)
    if prefix:
        _names(prefix)
    source = spark.table(table)
    kind = source.schema[entity].dataType.simpleString()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    inner = ", ".join(f"r.`{f.name}`" for f in source.schema)
    bodies = {
        f"{prefix}last_rows": (
            f"wanted {kind}", f"TABLE ({columns})",
            # The test of the entity reaches both sides, below the aggregate too.
            f"SELECT {inner} FROM {table} r JOIN (SELECT {entity} AS who, max({time}) AS last FROM {table} "
            f"GROUP BY {entity}) l ON r.{entity} = l.who AND r.{time} = l.last WHERE r.{entity} = wanted",
        ),
        f"{prefix}has_rows": (
            f"wanted {kind}", "BOOLEAN", f"(SELECT count(*) > 0 FROM {table} r WHERE r.{entity} = wanted)",
        ),
        f"{prefix}daily_avg": (
            "wanted DATE", "DOUBLE",
            f"(SELECT avg(r.{value}) FROM {table} r WHERE CAST(r.{time} AS DATE) = wanted)",
        ),
        f"{prefix}row_share": (
            f"wanted {kind}", "DOUBLE",
            f"CAST(round(CAST(try_divide((SELECT count(*) FROM {table} r WHERE r.{entity} = wanted) * 100.0BD, "
            f"(SELECT count(*) FROM {table})) AS DECIMAL(38, 10)), 2) AS DOUBLE)",
        ),
    }
    for name, (arguments, result, body) in bodies.items():
        kind_of = "RETURNS " + result + " RETURN "
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) {kind_of}{body}")
    return list(bodies)
