"""All registered queries and checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardlens.plans import (  # noqa: F401  (importing registers the queries)
    joins_and_aggregates,
    scalars_and_reports,
    tables_and_filters,
    windows_and_ranks,
)
from wardlens.plans.registry import CHECKS, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def checks() -> dict[str, str]:
    return dict(CHECKS)
